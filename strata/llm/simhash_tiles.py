"""SimHash near-dedup by tiled exact comparison.

Fingerprint: every run of ``shingle`` words (A-Z lower-cased, repeats
included) is hashed by XXH64; a bit is 1 when set in over half the hashes.
Texts of fewer words are one shingle; texts without words have fingerprint
zero and are linked like any other.

Links are found among distinct fingerprints, never among documents, so a
group of exact copies costs one row. Two fingerprints at distance ``radius``
or less agree on at least one of ``radius + 1`` blocks of their bits, so each
one is sent to a cell per block: the cell of the lowest ``w`` bits of that
block. ``w`` follows from the counted fingerprints, so that a cell holds about
``CELL`` rows whatever their number (one cell for all, if they are fewer).

A cell's rows are ordered by bit count and cut into tiles of ``SIDE`` rows;
pairs of tiles are compared with numpy (exclusive-or of rows against rows, bit
counts), and pairs whose bit counts differ by more than the radius are
skipped: most of them are (``tile_counts`` counts both). A cell of more than
``TILE`` rows (near copies of one text, a third of all rows perhaps) is cut
into parts by bit count and by hash, and each pair of parts becomes a task
group of its own; pairs of parts that are too far apart are never formed. Each
group returns a spanning forest of its links (every row with the smallest row
it reaches), not all pairs; that loses no connection.

Connected components: alternating large-star and small-star rounds on the
links, each round a written table; labels are the smallest ids of a
component. Every step is exact; block and tile sizes only place the work.

Defined cases: a null text is an empty text; a null id takes no part in the
minimum (a component with null ids only has a null component_id); repeated
rows are rows of their own with equal results; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import LOWER, UPPER, Scratch, drop, stage, whole_groups

SHINGLE = 3
RADIUS = 2
SEED = 42
CELL = 2048                # rows that a cell is meant to hold
TILE = 4096                # rows beyond which a cell is dealt to many groups
SIDE = 128                 # rows of a tile

_words = re.compile(r"[^\x20\x09-\x0D]+").findall
_LOWER = str.maketrans(UPPER, LOWER)


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text."""
    import xxhash
    words = _words(text.translate(_LOWER))
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(" ".join(words).encode(), seed)
    else:
        grams = map(" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
        hashes = b"".join([digest(g.encode(), seed) for g in grams])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(rows), 65536):
        ones += np.unpackbits(rows[a:a + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """long: the fingerprint's 64 bits, signed."""
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            bits = np.array([fingerprint(t, shingle, seed) for t in batch], np.uint64)
            yield pd.Series(bits.view(np.int64))
    return run(F.coalesce(text, F.lit("")))


def cell_bits(n: int, radius: int = RADIUS, cell: int = CELL) -> int:
    """Bits of a block that name a cell, so that ``n`` fingerprints fill
    cells of about ``cell`` rows."""
    return min(64 // (radius + 1), max(0, (max(n, 1) - 1) // cell).bit_length())


def _cells(prints: DataFrame, radius: int, bits: int) -> DataFrame:
    """(cell, fp, ones): a row per fingerprint and block."""
    blocks = radius + 1 if bits else 1
    low = [F.shiftrightunsigned("fp", 64 * k // (radius + 1)).bitwiseAND((1 << bits) - 1) for k in range(blocks)]
    cells = [F.xxhash64(F.lit(k), x) for k, x in enumerate(low)]
    return prints.select("fp", F.bit_count("fp").alias("ones"), F.explode(F.array(*cells)).alias("cell"))


def tile_groups(cells: DataFrame, radius: int, tile: int, scratch: Scratch) -> DataFrame:
    """(task, fp, ones) of (cell, fp, ones): cells as they are or, beyond
    ``tile`` rows, as pairs of tiles whose ``ones`` (0 to 64) differ by at
    most ``radius``."""
    counts = cells.groupBy("cell", "ones").agg(F.count(F.lit(1)).alias("n"))
    large = (counts.groupBy("cell")
             .agg(F.sum("n").alias("rows"),
                  F.map_from_entries(F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("parts")))).alias("tiles"))
             .filter(F.col("rows") > tile).select("cell", "tiles"))      # one row per large cell, 65 bit counts at most
    large = scratch.stage(large, "simhash-large")     # a table: the join below can split a cell of many rows
    rows = cells.join(large, "cell", "left")
    own = F.struct(F.col("ones").alias("o"), F.pmod(F.xxhash64("fp"), F.element_at("tiles", F.col("ones"))).cast("int").alias("p"))
    near = F.sequence(F.greatest(F.lit(0), F.col("ones") - radius), F.least(F.lit(64), F.col("ones") + radius))
    others = F.flatten(F.transform(near, lambda o: F.when(
        F.col("tiles")[o].isNotNull(),
        F.transform(F.sequence(F.lit(0), F.col("tiles")[o] - 1), lambda p: F.struct(o.alias("o"), p.cast("int").alias("p")))
    ).otherwise(F.array().cast("array<struct<o:int,p:int>>"))))
    mine = lambda x: F.struct(F.least(x, F.col("own")).alias("a"), F.greatest(x, F.col("own")).alias("b"))
    split = (rows.filter("tiles IS NOT NULL").withColumn("own", own).withColumn("others", others)
             .select(F.explode(F.transform("others", lambda x: F.xxhash64(F.col("cell"), mine(x)))).alias("task"), "fp", "ones"))
    return rows.filter("tiles IS NULL").select(F.col("cell").alias("task"), "fp", "ones").unionByName(split)


def _forest(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Each row with the smallest row it reaches over the links (a, b)."""
    root = np.arange(len(fp))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return list(zip(fp[moved].tolist(), fp[root[moved]].tolist(), strict=True))


def tile_pairs(ones: np.ndarray, radius: int, side: int = SIDE) -> Iterator[tuple[int, int]]:
    """Starts of the pairs of tiles, among rows ordered by bit count, whose
    bit counts come within the radius."""
    for s in range(0, len(ones), side):
        top = ones[min(s + side, len(ones)) - 1] + radius
        for t in range(s, len(ones), side):
            if ones[t] > top:
                break                                    # all later tiles are too far apart
            yield s, t


def compare_rows(fp: np.ndarray, ones: np.ndarray, radius: int, side: int = SIDE) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) among rows ordered by bit count, tile against tile."""
    bits = fp.view(np.uint64)
    ia, ib = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s, t in tile_pairs(ones, radius, side):
        near = np.bitwise_count(bits[s:s + side, None] ^ bits[None, t:t + side]) <= radius
        if s == t:
            near = np.triu(near, 1)
        if near.any():
            x, y = np.nonzero(near)
            ia.append(x + s)
            ib.append(y + t)
    return np.concatenate(ia), np.concatenate(ib)


def _per_group(groups: DataFrame, found, schema: str) -> DataFrame:
    """``found(fp, ones)`` of every task group, as rows."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, "task"):
            task, fp, ones = (rows[c].to_numpy(np.int64) for c in ("task", "fp", "ones"))
            cuts = np.flatnonzero(np.r_[True, task[1:] != task[:-1], True])
            out = [r for s, e in zip(cuts[:-1], cuts[1:], strict=True) for r in found(fp[s:e], ones[s:e])]
            yield pd.DataFrame(out, columns=names, dtype="int64")

    return groups.repartition("task").sortWithinPartitions("task", "ones", "fp").mapInPandas(run, schema)


def _groups(prints: DataFrame, radius: int, tile: int, cell: int, scratch: Scratch | None) -> DataFrame:
    return tile_groups(_cells(prints, radius, cell_bits(prints.count(), radius, cell)), radius, tile, scratch or Scratch())


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE, scratch: Scratch | None = None, cell: int = CELL) -> DataFrame:
    """(u, v) of distinct fingerprints: spans every pair within the radius."""
    def found(fp, ones):
        a, b = compare_rows(fp, ones, radius)
        return _forest(fp, a, b) if len(a) else []

    return _per_group(_groups(prints, radius, tile, cell, scratch), found, "u long, v long").distinct()


def tile_counts(prints: DataFrame, radius: int = RADIUS, tile: int = TILE, cell: int = CELL) -> DataFrame:
    """(compared, skipped): pairs of tiles of all groups that ``links``
    compares, and that their bit counts rule out."""
    def found(fp, ones):
        n, compared = -(-len(fp) // SIDE), sum(1 for _ in tile_pairs(ones, radius))
        return [(compared, n * (n + 1) // 2 - compared)]

    counts = _per_group(_groups(prints, radius, tile, cell, None), found, "compared long, skipped long")
    return counts.agg(F.sum("compared").alias("compared"), F.sum("skipped").alias("skipped"))


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v): large-star and
    small-star rounds until nothing changes; root is the smallest node."""
    spark = edges.sparkSession

    def signature(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now, path = stage(edges.filter("u != v").distinct(), "simhash-links")
    seen = signature(now)
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the smallest neighbours are written: a join with a written table can split a
        # node of very many links, a join with the aggregate itself can't
        least, least_path = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "simhash-least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down, down_path = stage(large.filter("u != v").distinct(), "simhash-down")      # u > v
        floor, floor_path = stage(down.groupBy("u").agg(F.min("v").alias("m")), "simhash-floor")
        small = (down.join(floor, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(floor.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        after, after_path = stage(small, "simhash-links")
        drop(spark, path, least_path, down_path, floor_path)
        new = signature(after)
        now, path = after, after_path
        if new == seen:
            if scratch is not None:
                scratch.paths.append(path)
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        seen = new


def dedup_classes(docs: DataFrame, *, id_col="doc_id", text_col="text", shingle=SHINGLE, radius=RADIUS, tile=TILE, cell=CELL,
                  kept: Scratch | None = None) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id), one row per input row;
    root is a fingerprint that names the component. The result is a written
    table; ``kept`` learns its path, to drop it when it is no longer read."""
    scratch = Scratch()
    prints = scratch.stage(docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
        fingerprint_column(F.col(text_col), shingle).alias("fp")), "simhash-prints")
    distinct = scratch.stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    found = components(links(distinct.select("fp"), radius, tile, scratch, cell), scratch)
    rooted = scratch.stage(distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    smallest = scratch.stage(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-least")
    classes = scratch.stage(rooted.join(smallest, "root").select("fp", "root", "component_id"), "simhash-classes")
    out = (kept or Scratch()).stage(prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id"), "simhash")
    scratch.drop(docs.sparkSession)
    return out


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
