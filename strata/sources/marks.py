"""A stored high-water mark for incremental loads.

The mark is a small table beside the load, of three kinds of rows:

* ``row``: key and time of the rows loaded within ``lookback`` of the newest
  time loaded so far (the mark);
* ``null``: keys of the loaded rows that have no time;
* ``day``: number of rows loaded per day.

An increment is every row at or after mark minus ``lookback`` and every row
without a time, less those that the log holds (null-safe on the key), so a row
that arrives up to ``lookback`` late is taken, exactly once however loads are
cut. Rows that arrive later than that are not taken: ``too_late`` counts them
by day, from the source's counts and the stored ones. An empty increment
leaves the mark as it is; a failed write leaves the old one.

A row is known by its key and time: a second row with the same key and time
counts as the same row in later loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.tables import files
from strata.tables.writes import write_replace

LOOKBACK = "2 days"


def _stored(spark: SparkSession, mark_path: str) -> DataFrame | None:
    files.recover(spark, mark_path)
    return spark.read.parquet(mark_path) if files.exists(spark, mark_path) else None


def _newest(mark: DataFrame, ts_col: str):
    return mark.filter("kind = 'row'").agg(F.max(ts_col)).first()[0]


def _bound(at, like: DataFrame, ts_col: str, lookback: str) -> F.Column:
    """Earliest time of the log, a literal of the column's type (pushed to the scan)."""
    kind = like.schema[ts_col].dataType
    earliest = like.sparkSession.range(1).select((F.lit(at).cast(kind) - F.expr(f"INTERVAL {lookback}")).cast(kind)).first()[0]
    return F.lit(earliest).cast(kind)


def increment(spark: SparkSession, df: DataFrame, mark_path: str, key: str, ts_col: str, lookback: str = LOOKBACK) -> DataFrame:
    """Rows of ``df`` that are not loaded yet (all, before the first mark)."""
    mark = _stored(spark, mark_path)
    if mark is None:
        return df
    at, t = _newest(mark, ts_col), F.col(ts_col)
    near = df.filter(t.isNull() | (t >= _bound(at, df, ts_col, lookback))) if at is not None else df
    known = mark.filter("kind != 'day'").select(F.col(key).alias("_key"), F.col(ts_col).alias("_ts"))
    return near.join(known, F.col(key).eqNullSafe(F.col("_key")) & t.eqNullSafe(F.col("_ts")), "left_anti")


def advance(spark: SparkSession, loaded: DataFrame, mark_path: str, key: str, ts_col: str, lookback: str = LOOKBACK) -> None:
    """Store the mark after ``loaded`` (an increment, written) was taken."""
    row = loaded.select(F.when(F.col(ts_col).isNull(), "null").otherwise("row").alias("kind"), key, ts_col,
                        F.to_date(ts_col).alias("day"), F.lit(1).cast("long").alias("n"))
    if loaded.limit(1).count() == 0:
        return
    old = _stored(spark, mark_path)
    log = row if old is None else row.unionByName(old.filter("kind != 'day'"))
    days = row if old is None else row.unionByName(old.filter("kind = 'day'"))
    at = _newest(log, ts_col)
    if at is not None:
        log = log.filter(F.col(ts_col).isNull() | (F.col(ts_col) >= _bound(at, loaded, ts_col, lookback)))
    days = days.groupBy("day").agg(F.sum("n").alias("n"))
    kinds = {f.name: f.dataType for f in loaded.schema.fields}
    days = days.select(F.lit("day").alias("kind"), F.lit(None).cast(kinds[key]).alias(key), F.lit(None).cast(kinds[ts_col]).alias(ts_col), "day", "n")
    write_replace(log.dropDuplicates(["kind", key, ts_col]).unionByName(days).coalesce(8), mark_path)


def too_late(spark: SparkSession, df: DataFrame, mark_path: str, ts_col: str) -> DataFrame:
    """(day, in_source, loaded, missed): days of which the source has more
    rows than were loaded, counted in one narrow pass."""
    counts = df.groupBy(F.to_date(ts_col).alias("day")).agg(F.count(F.lit(1)).alias("in_source"))
    mark = _stored(spark, mark_path)
    stored = (mark.filter("kind = 'day'").select("day", F.col("n").alias("loaded")) if mark is not None
              else spark.createDataFrame([], "day date, loaded long"))
    both = counts.join(stored.withColumnRenamed("day", "_day"), F.col("day").eqNullSafe(F.col("_day")), "left").drop("_day")
    both = both.withColumn("loaded", F.coalesce("loaded", F.lit(0)))
    return both.withColumn("missed", F.col("in_source") - F.col("loaded")).filter("missed > 0")
