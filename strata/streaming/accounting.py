"""Late rows kept and every row accounted for: a stream's rows behind the
watermark go to a side table instead of vanishing in a stateful operator, and
rows read = on time + late + without a time, by micro-batch.

Spark drops rows behind the watermark inside the stateful operator, where
nothing can read them (its counter counts partial aggregates, not rows). So the
split comes first, with a mark of its own that follows the same rule: the
newest time of earlier micro-batches less the delay. What passes is ahead of
any watermark of the same delay that a reader of whole batches can have
reached, so the stateful query behind it drops nothing; ``DropCounter`` shows
that it did not.
"""

from __future__ import annotations

import threading
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from strata.sources.readers import table_exists

KINDS = ("on_time", "late", "untimed")


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)


def _newest(spark: SparkSession, counts: str, batch_id: int):
    """Newest time seen before a micro-batch, as microseconds. Each batch's row
    carries the newest time up to it, so one row is read."""
    return spark.read.parquet(f"{counts}/batch={batch_id - 1}").first()["newest_us"] if batch_id else None


def window_end(ts: Column, seconds: int) -> Column:
    """End of the tumbling window of a time, as ``F.window`` cuts them; null
    for a null. (``F.window`` itself would drop rows without a time.)"""
    width = seconds * 1_000_000
    us = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(us - F.pmod(us, F.lit(width)) + width)


def split_late(events: DataFrame, ts: str, delay_seconds: int, out: str, checkpoint: str, window_seconds: int | None = None):
    """Deal each micro-batch by ``kind`` (on_time, late, untimed) to
    ``<out>/rows`` and add its row to ``<out>/counts`` (read, on_time, late,
    untimed, mark_us, newest_us).

    A row is late when its time, or with ``window_seconds`` the end of its
    tumbling window, is at or behind the mark = newest ``ts`` of earlier
    micro-batches less the delay; rows without ``ts`` are untimed. Rows keep their columns, with ``mark`` and
    ``behind_seconds`` (mark less ``ts``; negative ahead of the mark).

    Both folders are named by the batch id and overwritten, counts last, so a
    batch replayed after a failure replaces its own rows and sees the same mark.
    """
    counts = f"{out}/counts"
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    final_us = F.unix_micros(window_end(F.col(ts), window_seconds)) if window_seconds else us

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        newest = _newest(batch.sparkSession, counts, batch_id)
        mark_us = F.lit(None if newest is None else newest - delay_seconds * 1_000_000).cast("bigint")
        late = F.coalesce(final_us <= mark_us, F.lit(False))
        rows = batch.withColumns({
            "mark": F.timestamp_micros(mark_us), "behind_seconds": (mark_us - us) / 1_000_000.0,
            "kind": F.when(us.isNull(), "untimed").when(late, "late").otherwise("on_time")})
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _overwrite(rows, f"{out}/rows/batch={batch_id}", "kind")
            tally = rows.agg(F.count(F.lit(1)).alias("read"), *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS],
                             mark_us.alias("mark_us"), F.greatest(F.max(us), F.lit(newest).cast("bigint")).alias("newest_us"))
            _overwrite(tally, f"{counts}/batch={batch_id}")
        finally:
            rows.unpersist()

    return (events.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _with_split(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("mark", T.TimestampType()), T.StructField("behind_seconds", T.DoubleType()),
                         T.StructField("batch", T.IntegerType()), T.StructField("kind", T.StringType())])


def rows_of(spark: SparkSession, out: str, kind: str, schema: T.StructType) -> DataFrame:
    """Rows of one kind that ``split_late`` has written (``schema``: that of
    the events), with ``mark``, ``behind_seconds`` and ``batch``."""
    full = _with_split(schema)
    if not table_exists(spark, f"{out}/rows"):
        return spark.createDataFrame([], full).drop("kind")
    return spark.read.schema(full).parquet(f"{out}/rows").filter(F.col("kind") == kind).drop("kind")


def on_time_stream(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The on-time rows as a stream. One micro-batch takes whatever whole
    batches are there; don't cap its files, a batch cut in two could overtake
    its own mark."""
    stream = spark.readStream.schema(_with_split(schema)).parquet(f"{out}/rows")
    return stream.filter(F.col("kind") == "on_time").select(*schema.fieldNames())


class DropCounter(StreamingQueryListener):
    """Rows (or partial aggregates) that stateful operators dropped behind the
    watermark, by run of a query. Events arrive on the driver after the fact:
    ``dropped(query)`` waits for the end of that run."""

    def __init__(self):
        self._dropped: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        n = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        with self._lock:
            self._dropped[str(p.runId)] = self._dropped.get(str(p.runId), 0) + n

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def dropped(self, query, timeout: float = 60.0) -> int:
        run = str(query.runId)
        if not self._end(run).wait(timeout):
            raise TimeoutError(f"no end of query run {run} within {timeout} s")
        with self._lock:
            return self._dropped.get(run, 0)


def account(spark: SparkSession, out: str, emitted: DataFrame, events: str) -> DataFrame:
    """One row: read, on_time, late, untimed, emitted (sum of ``events`` over
    the groups that a stateful query has closed) and open (on time, in a group
    still open)."""
    names = ["read", *KINDS]
    parts = [emitted.select(F.col(events).cast("bigint").alias("emitted"))]
    if table_exists(spark, f"{out}/counts"):
        parts.append(spark.read.parquet(f"{out}/counts").select(*names))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    known = [n for n in ["emitted", *names] if n in rows.columns]
    out_row = rows.agg(*[total(c) for c in known]).withColumns({n: F.lit(0).cast("bigint") for n in names if n not in known})
    return out_row.select(*names, "emitted", (F.col("on_time") - F.col("emitted")).alias("open"))
