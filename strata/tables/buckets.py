"""Bucketed tables: recurring merges and joins by key without moving the table.

A bucketed table's files hold the rows of one hash bucket of the key each, so
a join on the key reads bucket by bucket; only the other side (a load's few
rows) is shuffled, to the table's buckets. For tables with a bounded number of
rows a key (a row per session, purchases): a bucket is read by one task, so a
table with hot keys belongs into ``tables.layout`` instead;
``check_balance`` refuses it before it is written.

The bucket layout is known from the catalog, not from the files: ``attach``
names the table at ``path`` again in a new session. A merge writes the new
table beside the old one and publishes it by renames. Null keys share one
bucket, never match in a merge, and stay.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import delete_path, indexed_timestamps, new_path
from strata.tables import files, writes

MAX_SKEW = 8.0                  # largest bucket against the mean
LEAST_ROWS = 100_000            # buckets of fewer rows are never too large


class UnevenBucketsError(ValueError):
    pass


def check_balance(df: DataFrame, keys, buckets: int, max_skew: float = MAX_SKEW, least_rows: int = LEAST_ROWS) -> None:
    """Raise when one bucket would hold more than ``max_skew`` times the mean
    (and more than ``least_rows`` rows). One row a bucket is counted."""
    bucket = F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(buckets))
    row = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    if (row["most"] or 0) > max(least_rows, max_skew * (row["all"] or 0) / buckets):
        raise UnevenBucketsError(f"a bucket of {row['most']} of {row['all']} rows: too many rows of one key for a bucketed table")


def attach(spark: SparkSession, name: str, path: str, keys, buckets: int, empty: DataFrame | None = None) -> DataFrame:
    """Name the bucketed table at ``path`` in this session's catalog.
    ``empty``: a frame with the columns of a table that has no row, hence
    no file, yet."""
    files.recover(spark, path)
    try:
        held = spark.read.parquet(path)
    except AnalysisException as e:
        if empty is None or e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        held = empty
    schema = held._jdf.schema().toDDL()
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, path: str, keys, buckets: int, placed: bool = False) -> DataFrame:
    """Replace the table ``name`` at ``path`` by ``df`` (which may read it).
    ``placed``: the rows are in their buckets' partitions already, so nothing
    is shuffled; else one shuffle puts them there."""
    spark, keys = df.sparkSession, list(keys)
    files.recover(spark, path)
    fresh, unnamed = files.beside(path, files.NEW), f"strata_new_{uuid.uuid4().hex}"
    rows = df if placed else df.repartition(buckets, *keys)
    try:
        with indexed_timestamps(spark):
            rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", fresh).saveAsTable(unnamed)
        files.publish(spark, fresh, path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {unnamed}")
        files.remove(spark, fresh)
    return attach(spark, name, path, keys, buckets, empty=df)


def merged(target: DataFrame, updates: DataFrame, keys, buckets: int, remove: DataFrame | None = None) -> DataFrame:
    """``writes.merge_upsert`` of a bucketed target: no exchange above the
    target's scan; updates (and removed keys) are put into its buckets."""
    keys = list(keys)
    placed = updates.repartition(buckets, *keys)
    gone = placed.select(*keys)
    if remove is not None:
        gone = gone.unionByName(remove.select(*keys).repartition(buckets, *keys))
    kept = target.join(gone.hint("shuffle_merge"), keys, "left_anti")
    return kept.unionByName(placed)


def merge_bucketed(spark: SparkSession, name: str, path: str, updates: DataFrame, keys, buckets: int,
                   remove: DataFrame | None = None) -> DataFrame:
    """Merge a load into the bucketed table: rows of its keys are replaced,
    others stay, keys in ``remove`` go. The load is staged once, so that it is
    computed once; more than one update for a held key raises before anything
    is written."""
    keys, scratch = list(keys), new_path(spark, "bucket_load")
    try:
        updates.write.parquet(scratch)
        rows = spark.read.schema(updates.schema).parquet(scratch)
        target = attach(spark, name, path, keys, buckets, empty=rows)
        writes.check_merge_cardinality(target, rows, keys)
        return write_bucketed(merged(target, rows, keys, buckets, remove), name, path, keys, buckets, placed=True)
    finally:
        delete_path(spark, scratch)


def exchanges_of_tables(df: DataFrame, *names: str) -> list[str]:
    """Names among ``names`` whose scan is below an exchange in ``df``'s plan."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    found = []

    def visit(node, moved: bool) -> None:
        moved = moved or "Exchange" in node.nodeName()
        text = node.nodeName()
        found.extend(n for n in names if moved and text.startswith("Scan") and text.endswith(n))
        for i in range(node.children().size()):
            visit(node.children().apply(i), moved)

    visit(plan, False)
    return found
