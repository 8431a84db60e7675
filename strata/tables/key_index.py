"""Per-partition key filters beside a partitioned table.

For every partition, the keys' hashes set bits in bitmaps of 32,768 bits
(Spark's bitmap size): ``2 ** level`` bitmaps a partition, about
``BITS_PER_KEY`` bits a key, ``PROBES`` bits of one bitmap for each key. A
load looks up its keys and learns which partitions can hold older copies;
their keys are then compared exactly, so a wrong "can hold" only costs a read.
A lookup takes (keys x partitions) probes; of more than ``MANY`` keys some hit
every partition by chance, so these are not looked up at all.

A filter is used only while it describes its partition's files: the digest of
the file names is stored with it, and a partition that was written by other
means (or whose filter was never written) counts as one that can hold any key.
The filters live in ``<path>__keys``, partitioned like the table and sorted by
bitmap number, so that a small load reads only the bitmaps its keys point to.
"""

from __future__ import annotations

import hashlib
import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.tables import files

BITMAP = 32_768
BITS_PER_KEY = 16
PROBES = 3
POINTED = 2_000                 # bitmaps looked up by a pushed list of numbers
MANY = 20_000                   # keys of a load that aren't looked up: wrong hits (about 1 in 1,400) name every partition of any size
SCHEMA = "part string, level int, files string, number long, bits binary"


def index_path(path: str) -> str:
    return path.rstrip("/") + "__keys"


def _hash(keys) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _present(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _bitmap_number(h: Column, level: Column) -> Column:
    return F.pmod(h, F.pow(F.lit(2.0), level).cast("long"))


def _bits(h: Column) -> list[Column]:
    g = F.xxhash64(h, F.lit(1))
    return [F.shiftrightunsigned(g, 15 * k).bitwiseAND(F.lit(BITMAP - 1)) for k in range(PROBES)]


def file_digests(table: DataFrame, path: str) -> dict[str, str]:
    """Partition value (text) -> digest of its data files' names, from the
    listing that reading the table makes anyway."""
    names: dict[str, list] = {}
    for f in table.inputFiles():
        folder, _, name = f.rpartition("/")
        value = unquote(unquote(folder.rpartition("/")[2])).partition("=")[2]
        names.setdefault(value, []).append(unquote(name))
    return {v: hashlib.md5("/".join(sorted(n)).encode()).hexdigest() for v, n in names.items()}


def write(spark: SparkSession, path: str, keys, partition_col: str, values, null_value: str) -> None:
    """Append the filters of the partitions ``values`` (text) of a table, as
    they are now."""
    from strata.tables.writes import in_partitions

    table = spark.read.parquet(path)
    digests = file_digests(table, path)
    part = F.coalesce(F.col(partition_col).cast("string"), F.lit(null_value))
    rows = table.filter(in_partitions(partition_col, values)).filter(_present(keys)).select(part.alias("part"), _hash(keys).alias("_h"))
    counts = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}    # a row per partition
    described = [(v, max(0, math.ceil(math.log2(max(1, n) * BITS_PER_KEY / BITMAP))), digests[v]) for v, n in counts.items() if v in digests]
    if not described:
        return
    levels = spark.createDataFrame(described, "part string, level int, files string")
    rows = rows.join(F.broadcast(levels), "part").select(
        "part", "level", "files", _bitmap_number(F.col("_h"), F.col("level")).alias("number"),
        F.explode(F.array(*_bits(F.col("_h")))).alias("bit"))
    maps = rows.groupBy("part", "level", "files", "number").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))
    maps.sortWithinPartitions("number").write.mode("append").parquet(index_path(path))


def _compacted(spark: SparkSession, index: DataFrame, path: str, usable: dict) -> DataFrame:
    from strata.tables.writes import write_replace

    write_replace(_of(index, usable), index_path(path))
    return spark.read.schema(SCHEMA).parquet(index_path(path))


def _of(index: DataFrame, usable: dict) -> DataFrame:
    return index.filter(F.col("part").isin(list(usable)) & F.col("files").isin([f for _, f in usable.values()]))


def candidates(spark: SparkSession, path: str, loaded: DataFrame, keys, table: DataFrame | None = None) -> set:
    """Partition values (text) that can hold a key of ``loaded``; partitions
    without a filter that fits are among them."""
    table = spark.read.parquet(path) if table is None else table
    held = file_digests(table, path)
    files.recover(spark, index_path(path))
    if not files.exists(spark, index_path(path)):
        return set(held)
    if loaded.filter(_present(keys)).agg(F.approx_count_distinct(_hash(keys))).first()[0] > MANY:
        return set(held)
    index = spark.read.schema(SCHEMA).parquet(index_path(path))
    hashes = loaded.filter(_present(keys)).select(_hash(keys).alias("_h")).distinct()
    with ThreadPoolExecutor(2) as pool:            # two small jobs
        known = pool.submit(lambda: index.select("part", "files", "level").distinct().collect())        # a row per version of a partition
        few = pool.submit(lambda: hashes.limit(POINTED + 1).collect())
        known, few = known.result(), few.result()
    usable = {r["part"]: (r["level"], r["files"]) for r in known if held.get(r["part"]) == r["files"]}
    if not usable:
        return set(held)
    if len(known) > 3 * len(held) + 16:
        index = _compacted(spark, index, path, usable)
    index = _of(index, usable)
    levels = sorted({level for level, _ in usable.values()})
    if len(few) <= POINTED:                        # a pushed filter: only bitmaps that the keys point to are read
        hashes = spark.createDataFrame([(r["_h"],) for r in few], "_h long")
        index = index.filter(F.col("number").isin(sorted({r["_h"] % 2 ** level for r in few for level in levels})))
    probes = hashes.select("_h", F.explode(F.array(*map(F.lit, levels))).alias("level"))
    probes = probes.select("level", _bitmap_number(F.col("_h"), F.col("level")).alias("number"), F.array(*_bits(F.col("_h"))).alias("_bits"))
    byte = lambda b: F.conv(F.hex(F.substring("bits", (F.shiftright(b, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = lambda b: byte(b).bitwiseAND(F.pow(F.lit(2), b.bitwiseAND(F.lit(7))).cast("int")) != 0
    found = index.join(probes, ["level", "number"]).filter(F.forall("_bits", is_set)).select("part").distinct().collect()
    return {r["part"] for r in found} | (set(held) - set(usable))
