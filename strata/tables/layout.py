"""Clustered table layout: a space-filling curve over a key and a time.

Rows are ordered by a Morton (Z-order) key, the interleaved bits of the hash
of a key (user) and of a time's place between the table's first and last
time, and cut into files by range partitioning on it. Bits that don't vary
leave the cut to the others, and the cut is made by sampled ranks, so files
are of one size whatever the skew; rows of one curve key are ordered by key,
time and a hash of all plain columns, so a hot user at one instant is cut as well.

Every file then holds few users and a short span of time: Parquet's Bloom
filters (or full dictionaries) on the named key columns and the minimum and
maximum of the time let a lookup by user, by session or by time skip the row
groups that can't hold its rows. Nulls have curve bits 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from strata.session import indexed_timestamps
from strata.tables import files

BITS = 31                       # bits a dimension; the curve key is a long >= 0
ROWS_PER_FILE = 4_000_000
ROWS_PER_GROUP = 250_000
# Masks that spread the low 32 bits of a long to its even bits.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
           (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread(bits: Column) -> Column:
    for by, mask in _SPREAD:
        bits = bits.bitwiseOR(F.shiftleft(bits, by)).bitwiseAND(F.lit(mask))
    return bits


def curve_key(x: Column, y: Column) -> Column:
    """Morton key of two long columns in [0, 2^31): x has the higher bits."""
    return F.shiftleft(_spread(x), 1).bitwiseOR(_spread(y))


def _hash_bits(key: str) -> Column:
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(
        F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 64 - BITS))


def _time_bits(time: str, first: int | None, last: int | None) -> Column:
    if first is None:
        return F.lit(0).cast("long")
    at = (F.unix_micros(F.col(time).cast("timestamp")) - F.lit(first)) / F.lit(float(max(1, last - first)))
    return F.coalesce(F.floor(at * F.lit(float((1 << BITS) - 1))), F.lit(0))


def write_clustered(df: DataFrame, path: str, key: str, time: str, lookups=(), rows_per_file: int = ROWS_PER_FILE,
                    rows_per_group: int = ROWS_PER_GROUP) -> int:
    """Write ``df`` (which may read the table) ordered by the curve over
    (``key``, ``time``), published when complete. ``lookups``: columns that
    get a Bloom filter (besides ``key``). Returns the number of files asked
    for. To recluster a table that grew by appends, write it again."""
    spark, lookups = df.sparkSession, sorted({key, *lookups})
    files.recover(spark, path)
    us = F.unix_micros(F.col(time).cast("timestamp"))
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.min(us).alias("first"), F.max(us).alias("last"),
                  *[F.approx_count_distinct(c).alias(f"d_{i}") for i, c in enumerate(lookups)]).first()
    n = max(1, math.ceil(seen["n"] / rows_per_file))
    curve = "_curve"
    while curve in df.columns:
        curve += "_"
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    ties = F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    out = (df.withColumn(curve, curve_key(_hash_bits(key), _time_bits(time, seen["first"], seen["last"])))
           .repartitionByRange(n, F.col(curve), F.col(key), F.col(time), ties)
           .sortWithinPartitions(curve, key, time))
    writer = out.drop(curve).write.option("parquet.block.row.count.limit", rows_per_group)
    for i, c in enumerate(lookups):
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{c}", max(1, min(rows_per_group, seen[f"d_{i}"]))))
    fresh = files.beside(path, files.NEW)
    try:
        with indexed_timestamps(spark):
            writer.parquet(fresh)
        files.publish(spark, fresh, path)
    finally:
        files.remove(spark, fresh)
    return n


def scanned_rows(df: DataFrame) -> int:
    """Run ``df`` (filters and projections over files) and return the rows
    its scans gave out: those of row groups and pages not skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def per_file_spans(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file, rows, first, last) of a table's column: how well a layout
    separates it. One aggregate, a row per file."""
    return spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("first"), F.max(column).alias("last"))
