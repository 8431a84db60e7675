"""Structured Streaming jobs: ingest with quarantine, dedup within the
watermark, session aggregation, and gold upserts for late events.

Every query has a checkpoint folder (offsets + state), so a restarted job
resumes where it stopped. ``foreachBatch`` sinks write each micro-batch to
an idempotent target (a folder named by the batch id, or a keyed upsert),
so a batch replayed after a failure does not duplicate rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.ordered import first_by_time, last_by_time
from strata.functions.scalar import parse_timestamp
from strata.operators.cleaning import latest_per_key, require_not_null, split_corrupt
from strata.plans import silver
from strata.sources.readers import parse_csv_lines, parse_json_lines
from strata.sources.schemas import CORRUPT_COL, LANDED_EVENT

EVENT_KEYS = ["event_id", "user_id", "session_id", "event_type"]


def json_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def parquet_stream(spark: SparkSession, folder: str, file_glob: str | None = None,
                   schema=None) -> DataFrame:
    """File stream over parquet files of a folder (``file_glob`` picks some)."""
    r = spark.readStream
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if schema is None:
        schema = spark.read.option("pathGlobFilter", file_glob or "*").parquet(folder).schema
    return r.schema(schema).parquet(folder)


def clean_events(parsed: DataFrame) -> DataFrame:
    """Typed rows of landed events: null keys dropped, timestamp parsed,
    value lifted from the payload (stream-safe: no dedup here)."""
    df = require_not_null(parsed, EVENT_KEYS)
    return df.select("event_id", "session_id", "user_id", "event_type",
                     parse_timestamp("event_timestamp").alias("event_timestamp"),
                     F.col("event_details.price").alias("value"))


# ------------------------------------------------------------------ ingest


def ingest(lines: DataFrame, sink: str, quarantine: str, checkpoint: str,
           date_col: str = "event_date", available_now: bool = True):
    """JSON lines -> parquet partitioned by event date, malformed and blank
    lines -> quarantine text, well-formed lines without a key ->
    ``<quarantine>_null_keys``. Each micro-batch writes under ``batch=<id>``
    with overwrite, so a replayed batch replaces its own output; ``rebalance``
    keeps one date's rows together, so a batch writes few files."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_json_lines(batch, "value", LANDED_EVENT, CORRUPT_COL)
        parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid, bad = split_corrupt(parsed)
            rows = clean_events(valid).withColumn(date_col, F.to_date("event_timestamp"))
            (rows.hint("rebalance", date_col).write.mode("overwrite").partitionBy(date_col)
             .parquet(f"{sink}/batch={batch_id}"))
            keyless = valid.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in EVENT_KEYS]))
            keyless.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(
                f"{quarantine}_null_keys/batch={batch_id}")
            bad.write.mode("overwrite").text(f"{quarantine}/batch={batch_id}")
        finally:
            parsed.unpersist()

    w = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


# ------------------------------------------------------------------- dedup


def dedup_stream(events: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Drop re-deliveries of a key seen within the watermark delay. Keeps
    the first copy seen (not the newest): state per key lives until the
    watermark passes it."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


# ---------------------------------------------------------------- sessions


def session_stream(events: DataFrame, user: str = "user_id", ts: str = "event_timestamp",
                   event_id: str = "event_id", event_type: str = "event_type",
                   delay: str = "2 days", gap: str | None = None) -> DataFrame:
    """Sessions per user, emitted once the watermark closes them (append).

    Default session = the user's calendar day (a 1-day tumbling window),
    the same key as the batch layer; with ``gap`` a session window closes
    after ``gap`` of inactivity. Events later than ``delay`` behind the
    newest event are dropped by the watermark (see ``late_event_report``).
    """
    win = F.session_window(ts, gap) if gap else F.window(ts, "1 day")
    agg = (events.withWatermark(ts, delay).groupBy(win.alias("w"), user).agg(
        F.min(ts).alias("session_start_time"),
        F.max(ts).alias("session_end_time"),
        F.count(event_id).alias("total_events"),
        first_by_time(event_type, ts, event_id).alias("first_event_type"),
        last_by_time(event_type, ts, event_id).alias("last_event_type")))
    sid = F.concat(F.col(user).cast("string"), F.lit("_"), F.to_date("w.start").cast("string"))
    return agg.select(sid.alias("session_id"), user, F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "session_start_time", "session_end_time",
                      "total_events", "first_event_type", "last_event_type")


# ------------------------------------------------------------- gold upsert


def load_stream(lines: DataFrame, name: str, paths: dict, checkpoint: str, clean, sources: dict | None = None,
                available_now: bool = True, rejected=None):
    """Each micro-batch of ``lines`` is one load of silver table ``name``
    (``plans.medallion.merge_load``): merged by key, then the sessions it
    touches are recomputed from silver and upserted into gold. ``clean``
    turns the batch's lines into rows, one per key. Streams of events,
    purchases and users can keep the same tables one after the other; a
    replayed batch changes nothing.

    ``rejected`` (by default ``clean.rejected``, if it has one) gives the lines
    that ``clean`` leaves out, (value, reason); they are written to
    ``<quarantine>/stream=<name>/batch=<id>`` before the load, so every line
    read is in silver, an older copy of a row there, or in quarantine."""
    from strata.plans import medallion
    rejected = rejected or getattr(clean, "rejected", None)
    quarantine = paths.get("quarantine") or paths[name].rstrip("/") + "_quarantine"
    argument = {"events_clean": "events", "transactions_clean": "transactions", "users_dim": "users"}[name]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if rejected is None:
            medallion.merge_load(batch.sparkSession, paths, **{argument: clean(batch)}, sources=sources)
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (rejected(batch).select("value", "reason").write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("reason").text(f"{quarantine}/stream={name}/batch={batch_id}"))
            medallion.merge_load(batch.sparkSession, paths, **{argument: clean(batch)}, sources=sources)
        finally:
            batch.unpersist()

    w = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _left_out(parsed: DataFrame, rules: dict) -> DataFrame:
    """(value, reason) of parsed lines: malformed ones as they came, others
    that break a rule (the first is the reason) as JSON."""
    valid, bad = split_corrupt(parsed)
    reason = F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    valid = valid.select(F.to_json(F.struct("*")).alias("value"), reason.alias("reason")).filter(F.col("reason").isNotNull())
    return bad.select(F.col(CORRUPT_COL).alias("value"), F.lit("malformed").alias("reason")).unionByName(valid)


def _any_null(cols) -> F.Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def newest_landed_events(batch: DataFrame) -> DataFrame:
    """Rows of landed event lines: no corrupt or null-key lines, the newest
    copy per event id."""
    valid, _ = split_corrupt(parse_json_lines(batch, "value", LANDED_EVENT, CORRUPT_COL))
    return latest_per_key(clean_events(valid), "event_id", "event_timestamp")


def rejected_landed_events(batch: DataFrame) -> DataFrame:
    """Lines that ``newest_landed_events`` leaves out: (value, reason)."""
    return _left_out(parse_json_lines(batch, "value", LANDED_EVENT, CORRUPT_COL), {"null_key": _any_null(EVENT_KEYS)})


newest_landed_events.rejected = rejected_landed_events


def newest_purchases(schema) -> Callable[[DataFrame], DataFrame]:
    """Rows of purchase CSV lines of ``schema``, newest copy per id."""
    def clean(batch: DataFrame) -> DataFrame:
        valid, _ = split_corrupt(parse_csv_lines(batch, "value", schema, CORRUPT_COL))
        return silver.transactions_clean(valid)

    def rejected(batch: DataFrame) -> DataFrame:
        return _left_out(parse_csv_lines(batch, "value", schema, CORRUPT_COL),
                         {"null_key": _any_null(silver.TRANSACTION_KEYS), "amount": ~(F.col("amount") > 0)})

    clean.rejected = rejected
    return clean


def gold_upsert(lines: DataFrame, silver_path: str, gold_path: str, checkpoint: str,
                transactions, users, available_now: bool = True):
    """Keep silver events and the gold session table current as events
    arrive, late ones included. ``transactions`` and ``users`` are tables
    kept elsewhere: frames, or functions that read them anew for each
    micro-batch. Purchases that arrive after their session's events are
    taken in by a ``load_stream`` of purchases."""
    read = lambda x: x if callable(x) else lambda: x
    paths = {"events_clean": silver_path, "user_session_analysis": gold_path}
    return load_stream(lines, "events_clean", paths, checkpoint, newest_landed_events,
                       {"transactions_clean": read(transactions), "users_dim": read(users)}, available_now)
