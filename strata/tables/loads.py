"""History by load: an append-only table partitioned by load number.

Every load is a partition of its own: the rows it set and the keys it removed
(tombstones). It is published whole (re-running a load replaces it), and no
load rewrites another one. A row is valid from its load until the next load
that sets or removes its key; reading an earlier state is reading the rows
valid at a load, and going back to one is a new load that undoes what came
after it, so the states in between stay readable.

Rows with a NULL key never replace one another, as in a MERGE; going back
voids those that came later. A load that sets and removes nothing leaves no
entry.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.tables import files
from strata.tables.writes import write_partitioned

LOAD = "load_id"
GONE = "_gone"                  # true: a tombstone (only its key is set), or the mark of a return
BACK_TO = "_back_to"            # the load that a return goes back to


def append_load(df: DataFrame, path: str, load: int, removed: DataFrame | None = None, keys=None,
                back_to: int | None = None) -> None:
    """Publish one load: rows ``df``, and the ``keys`` of ``removed``. A
    failure leaves the loads as they were."""
    spark = df.sparkSession
    rows = df.withColumns({GONE: F.lit(False), BACK_TO: F.lit(None).cast("int")})
    if removed is not None:
        gone = removed.select(*keys).distinct().withColumns({GONE: F.lit(True), BACK_TO: F.lit(None).cast("int")})
        rows = rows.unionByName(gone, allowMissingColumns=True)
    if back_to is not None:
        mark = spark.range(1).select(F.lit(True).alias(GONE), F.lit(back_to).cast("int").alias(BACK_TO))
        rows = rows.unionByName(mark, allowMissingColumns=True)
    files.recover(spark, path)
    fresh = files.beside(path, files.NEW)
    try:
        write_partitioned(rows.withColumn(LOAD, F.lit(load)), fresh, LOAD)
        files.publish_partitions(spark, fresh, path, [f"{LOAD}={load}"])
    finally:
        files.remove(spark, fresh)


def _present(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _returns(rows: DataFrame) -> list[tuple[int, int]]:
    """(load, load it went back to) of every return: a row each."""
    marks = rows.filter(F.col(GONE) & F.col(BACK_TO).isNotNull()).select(LOAD, BACK_TO).collect()
    return sorted((r[LOAD], r[BACK_TO]) for r in marks)


def _voided_by(returns) -> Column:
    """The load of the first return that voids a row without a key."""
    cases = [F.when((F.col(LOAD) > to) & (F.col(LOAD) < load), F.lit(load)) for load, to in returns]
    return F.coalesce(*cases) if cases else F.lit(None).cast("int")


def _internal(df: DataFrame) -> DataFrame:
    return df.drop(GONE, BACK_TO)


def as_of(spark: SparkSession, path: str, keys, load: int | None = None) -> DataFrame:
    """The table after load ``load`` (default: the newest); earlier loads
    only are read (partition pruning)."""
    keys = list(keys)
    rows = spark.read.parquet(path)
    if load is not None:
        rows = rows.filter(F.col(LOAD) <= load)
    newest = rows.filter(_present(keys)).groupBy(*keys).agg(F.max(LOAD).alias(LOAD))
    keyed = rows.filter(~F.col(GONE)).join(newest, [*keys, LOAD], "left_semi")
    keyless = rows.filter(~F.col(GONE) & ~_present(keys) & _voided_by(_returns(rows)).isNull())
    return _internal(keyed.unionByName(keyless)).drop(LOAD)


def intervals(spark: SparkSession, path: str, keys) -> DataFrame:
    """Every row ever set, with ``valid_from`` and ``valid_to``: the loads
    that set it and that replaced or removed it (NULL: still valid)."""
    keys = list(keys)
    rows = spark.read.parquet(path)
    steps = rows.filter(_present(keys)).select(*keys, LOAD).distinct()
    until = F.lead(LOAD).over(Window.partitionBy(*keys).orderBy(LOAD))
    keyed = rows.filter(~F.col(GONE)).join(steps.withColumn("valid_to", until), [*keys, LOAD])
    keyless = rows.filter(~F.col(GONE) & ~_present(keys)).withColumn("valid_to", _voided_by(_returns(rows)).cast("int"))
    return _internal(keyed.unionByName(keyless)).withColumnRenamed(LOAD, "valid_from")


def go_back(spark: SparkSession, path: str, keys, to: int, load: int) -> None:
    """Load ``load`` makes the table what it was after load ``to``: keys that
    later loads set or removed get their rows of then, or are removed. Only
    these keys are written."""
    keys = list(keys)
    later = spark.read.parquet(path).filter((F.col(LOAD) > to) & (F.col(LOAD) < load) & _present(keys)).select(*keys).distinct()
    then = as_of(spark, path, keys, to)
    removed = later.join(then.select(*keys), keys, "left_anti")
    append_load(then.join(later, keys, "left_semi"), path, load, removed=removed, keys=keys, back_to=to)


def load_history(spark: SparkSession, path: str, keys) -> DataFrame:
    """(load_id, row_count): rows of the table as of each load. One scan of
    keys: each row adds one at the load that set it and takes it back at the
    load that ended it; the counts are running sums over one row per load."""
    rows = intervals(spark, path, keys).select("valid_from", "valid_to")
    steps = rows.select(F.explode(F.array(
        F.struct(F.col("valid_from").alias(LOAD), F.lit(1).alias("d")),
        F.struct(F.col("valid_to").alias(LOAD), F.lit(-1).alias("d")))).alias("s")).select("s.*").filter(F.col(LOAD).isNotNull())
    every = spark.read.parquet(path).select(LOAD, F.lit(0).alias("d"))
    per_load = steps.unionByName(every).groupBy(LOAD).agg(F.sum("d").alias("d"))
    return per_load.select(LOAD, F.sum("d").over(Window.orderBy(LOAD)).alias("row_count"))
