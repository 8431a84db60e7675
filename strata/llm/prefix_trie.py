"""Conversation prefix trie over minimal-perfect-hash node tables.

``trie`` gives one row per distinct prefix of the conversations: members,
children, leaves below, the characters that storing it once saves, and the
digest of the members that end there.

1. ``rebuild`` (optional) grafts the first turns of a shared conversation
   onto each conversation, ``chain`` reads each conversation as a sorted
   stream and emits the 128-bit digest of every prefix (digest of the parent
   and the turn). Turns travel as digests; no text is shuffled.
2. Nodes are the distinct digests with their smallest member and count.
3. Subtree sums. Nodes are put into classes by their number of members: 1,
   up to ``FAN``, up to ``FAN`` squared, and so on. Members never grow
   downwards, so within a class the nodes form separate subtrees, each with at
   most ``FAN`` branches next to one another: a first turn that a third of
   all conversations share is cut into many small subtrees instead of one
   large one. Subtrees are dealt to shards by the digest of their top. In a
   shard, ``NodeTable`` gives every digest a slot of a minimal perfect hash
   (verified against the digest stored there), counts are scattered into flat
   arrays, and totals are added to the parent's slot, deepest level first.
   Tops then report to their parent in a higher class. Classes are worked
   from few members to many: a handful of rounds, log of the rows by ``FAN``.
   Nodes of one member are chains and need no sums.

Defined results. Null role or text: empty. Turns are taken by number, nulls
first; of one number by role, then by the digest of role and text. Rows with a
null id belong to no conversation. Repeated rows are repeated turns. Other
columns are ignored. Empty table: no rows, not even the root.

Bounds: a shard holds about ``SHARD_NODES`` nodes and whole subtrees, each of
at most ``FAN`` conversations. Digests of different prefixes are taken to
differ (128 bits).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch, stage

FAN = 256
SHARD_NODES = 8_192
RUN_IDS = 10_000                # ids that are joined into one row before they are hashed
OUT_ROWS = 20_000
LINK = "conv_id long, depth long, a long, b long, pa long, pb long, n_chars long, ends boolean"


# ------------------------------------------------------------ node table

def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """64 bits from both halves of a digest and a level."""
    x = a ^ (b * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class NodeTable:
    """Minimal perfect hash of distinct digests: slots 0 to n - 1.

    Per level, the digests left over are hashed into twice as many bits; one
    that is alone at its bit gets the bit's rank as slot, others go on to the
    next level. A look-up takes the first set bit and compares the digest
    stored in the slot, so digests that aren't in the table get -1.
    """

    MAX_LEVELS = 80

    def __init__(self, a: np.ndarray, b: np.ndarray):
        a, b = a.astype(np.int64).view(np.uint64), b.astype(np.int64).view(np.uint64)
        self.levels, self.slots, rest, base = [], np.empty(len(a), np.int64), np.arange(len(a)), 0
        while len(rest):
            if len(self.levels) == self.MAX_LEVELS:
                raise ValueError("the digests of a node table are not distinct")
            size = max(8, 2 * len(rest))
            at = (_mix(a[rest], b[rest], len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.cumsum(alone) - 1 + base
            here = alone[at]
            self.slots[rest[here]] = rank[at[here]]
            self.levels.append((size, alone, rank))
            base += int(here.sum())
            rest = rest[~here]
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        self.a[self.slots], self.b[self.slots] = a, b

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 where it isn't in the table."""
        a, b = a.astype(np.int64).view(np.uint64), b.astype(np.int64).view(np.uint64)
        out, rest = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (size, alone, rank) in enumerate(self.levels):
            at = (_mix(a[rest], b[rest], level) % np.uint64(size)).astype(np.int64)
            hit = alone[at]
            slot, who = rank[at[hit]], rest[hit]
            same = (self.a[slot] == a[who]) & (self.b[slot] == b[who])
            out[who[same]] = slot[same]
            rest = rest[~hit]
        return out


def add_up(nodes: pd.DataFrame) -> pd.DataFrame:
    """Children, leaves and savings of the nodes of one shard. ``n_children``,
    ``n_leaves`` and ``saved_tokens`` come in as what lower classes report and
    go out as totals of the whole subtrees."""
    table = NodeTable(nodes["a"].to_numpy(), nodes["b"].to_numpy())
    n, slots = len(nodes), table.slots

    def scattered(values) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[slots] = values
        return out

    parent, depth = scattered(table.find(nodes["pa"].to_numpy(), nodes["pb"].to_numpy())), scattered(nodes["depth"])
    children, leaves = scattered(nodes["n_children"]), scattered(nodes["n_leaves"])
    saved = scattered(nodes["saved_tokens"].to_numpy() + (nodes["n_convs"].to_numpy() - 1) * nodes["n_chars"].to_numpy())
    np.add.at(children, parent[parent >= 0], 1)
    leaves[children == 0] = 1
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    return nodes.assign(n_children=children[slots], n_leaves=leaves[slots], saved_tokens=saved[slots])


# ---------------------------------------------------------- conversations

def turns(rows: DataFrame, *, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(conv_id, part, turn, role, digest, n_chars): rows as digests of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return rows.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.lit(1).alias("part"), F.col(turn_col).cast("long").alias("turn"),
        role.alias("role"), F.unhex(F.sha2(whole, 256)).alias("digest"), F.length(text).cast("long").alias("n_chars"))


def _by_turn():
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def rebuild(own: DataFrame, source, n_first, most: int) -> DataFrame:
    """Replaces the first ``n_first`` turns (a column of conv_id, at most
    ``most``) of every conversation by those of conversation ``source`` (a
    column of conv_id): all that one has if fewer, none if it doesn't exist.
    ``part`` is 0 for grafted turns; own turns carry ``skip``, how many of
    them go. Grafted rows are few: at most ``most`` turns are read of each source."""
    ids = own.select("conv_id").distinct().select("conv_id", source.alias("source"), n_first.cast("int").alias("skip"))
    wanted = ids.select(F.col("source").alias("conv_id")).distinct()
    first = own.join(wanted, "conv_id", "left_semi").withColumn(
        "k", F.row_number().over(Window.partitionBy("conv_id").orderBy(*_by_turn()))).filter(F.col("k") <= most)
    grafted = ids.join(first.drop("part", "turn").withColumnRenamed("conv_id", "source"), "source").filter(F.col("k") <= F.col("skip"))
    grafted = grafted.select("conv_id", F.lit(0).alias("part"), F.col("k").cast("long").alias("turn"), "role", "digest", "n_chars",
                             F.lit(0).alias("skip"))
    return grafted.unionByName(own.withColumn("skip", n_first.cast("int")))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> a row per prefix; of a conversation without turns a
    row of depth 0."""
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), *[(c, pa.int64()) for c in ("a", "b", "pa", "pb", "n_chars")],
                        ("ends", pa.bool_())])
    halves = lambda d: (int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True))
    out, conv, depth, digest, own, held = [], None, 0, bytes(16), 0, None

    def close():
        if held is not None:
            out.append((*held, True))
        elif conv is not None:
            out.append((conv, 0, 0, 0, 0, 0, 0, True))

    for batch in batches:
        for c, part, skip, turn, n in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if c != conv:
                close()
                conv, depth, digest, own, held = c, 0, bytes(16), 0, None
            own += part
            if part and own <= skip:
                continue
            if held is not None:
                out.append((*held, False))
            before, digest, depth = digest, hashlib.blake2b(digest + turn, digest_size=16).digest(), depth + 1
            held = (c, depth, *halves(digest), *halves(before), n)
        if len(out) >= OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def chain(rebuilt: DataFrame) -> DataFrame:
    """A row (conv_id, depth, digest, digest of the parent, characters of the
    last text, whether it ends there) per prefix of each conversation."""
    rows = rebuilt.select("conv_id", "part", "turn", "role", "digest", "skip", "n_chars").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "part", *_by_turn())
    return rows.select("conv_id", "part", "skip", "digest", "n_chars").mapInArrow(_prefixes, LINK)


# ------------------------------------------------------------------- ends

def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Sorted (a, b, conv_id) -> runs of one node, ids joined by commas."""
    out, key, ids = [], None, []

    def cut():
        if ids:
            out.append((*key, ids[0], ",".join(map(str, ids))))

    for batch in batches:
        for a, b, c in zip(*[batch[x].tolist() for x in ("a", "b", "conv_id")], strict=True):
            if (a, b) != key or len(ids) == RUN_IDS:
                cut()
                key, ids = (a, b), []
            ids.append(c)
        if len(out) >= OUT_ROWS:
            yield pd.DataFrame(out, columns=["a", "b", "first", "ids"])
            out = []
    cut()
    yield pd.DataFrame(out, columns=["a", "b", "first", "ids"])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted runs -> SHA-256 of each node's ids, hashed as they come."""
    out, key, sha = [], None, None
    for batch in batches:
        for a, b, ids in zip(*[batch[x].tolist() for x in ("a", "b", "ids")], strict=True):
            if (a, b) != key:
                if sha is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (a, b), hashlib.sha256(ids.encode())
            else:
                sha.update(("," + ids).encode())
        if len(out) >= OUT_ROWS:
            yield pd.DataFrame(out, columns=["a", "b", "ends_sha256"])
            out = []
    if sha is not None:
        out.append((*key, sha.hexdigest()))
    yield pd.DataFrame(out, columns=["a", "b", "ends_sha256"])


def ends(links: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): digest of the ids that end at a node, ascending.
    Ids are sorted by range over all tasks, so a node at which a third of all
    conversations end is joined into runs by many tasks; one task hashes the
    runs in order."""
    rows = links.filter("ends").select("a", "b", "conv_id")
    runs = rows.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInPandas(
        _runs, "a long, b long, first long, ids string")
    return runs.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInPandas(_digests, "a long, b long, ends_sha256 string")


# ------------------------------------------------------------------- trie

SUMS = ["n_children", "n_leaves", "saved_tokens"]


def trie(rebuilt: DataFrame, *, fan: int = FAN, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rebuilt``: output of ``rebuild``, or of ``turns`` with ``skip`` 0."""
    spark, scratch = rebuilt.sparkSession, Scratch()
    links = scratch.stage(chain(rebuilt), "trie-links")
    total = links.agg(F.countDistinct("conv_id").alias("n"), F.min("conv_id").alias("root")).first()
    nodes = scratch.stage(links.filter("depth > 0").groupBy("a", "b").agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs")), "trie-nodes")
    most = nodes.agg(F.max("n_convs")).first()[0] or 1

    # class 0: one member; class k: up to fan ** k
    limits = [1]
    while limits[-1] < most:
        limits.append(limits[-1] * fan)
    cls = reduce(lambda x, y: x + y, [(F.col("n_convs") > x).cast("int") for x in limits])
    paths = links.filter("depth > 0").drop("ends").join(nodes, ["a", "b"]).withColumn("class", cls)
    along = Window.partitionBy("conv_id").orderBy("depth")
    within = Window.partitionBy("conv_id", "class").orderBy("depth")
    paths = paths.withColumns({
        "parent_rep": F.lag("rep").over(along), "inner": F.lead("depth").over(along).isNotNull(),
        "ta": F.first("a").over(within), "tb": F.first("b").over(within)})
    placed = scratch.stage(paths.filter("rep = conv_id").withColumn("top", (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb"))),
                           "trie-placed")

    columns = ["a", "b", "pa", "pb", "rep", "parent_rep", "depth", "n_convs", "n_chars", "top"]
    per_class = {r["class"]: r["n"] for r in placed.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    done, reports = [], []
    for k in sorted(per_class):
        mine = placed.filter(F.col("class") == k)
        if k == 0:                                  # chains: nothing to add up
            part = mine.select(*columns, F.col("inner").cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                               F.lit(0).cast("long").alias("saved_tokens"))
        else:
            mine = mine.select(*columns, F.pmod(F.xxhash64("ta", "tb"), F.lit(-(-per_class[k] // shard_nodes))).alias("shard"))
            if reports:
                told = reduce(DataFrame.unionByName, reports).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in SUMS])
                mine = mine.join(told, ["a", "b"], "left").fillna(0, SUMS)
            else:
                mine = mine.withColumns({c: F.lit(0).cast("long") for c in SUMS})
            mine = mine.select(*columns, *SUMS, "shard").withColumn("parent_rep", F.coalesce("parent_rep", "rep"))
            part = mine.groupBy("shard").applyInPandas(add_up, mine.schema).drop("shard")
            part = scratch.stage(part, "trie-class")
        done.append(part)
        reports.append(part.filter("top AND depth > 1").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))

    if not total["n"]:
        out = spark.createDataFrame([], "a long, b long, conv_id long, depth long, parent_conv_id long, n_convs long, "
                                        "n_children long, n_leaves long, saved_tokens long")
    else:
        first = (reduce(DataFrame.unionByName, [d.select("depth", *SUMS) for d in done]).filter("depth = 1") if done
                 else links.limit(0).selectExpr("depth", *[f"0L AS {c}" for c in SUMS]))
        root = first.agg(F.count(F.lit(1)).alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(1)).cast("long").alias("n_leaves"),
                         F.coalesce(F.sum("saved_tokens"), F.lit(0)).cast("long").alias("saved_tokens"))
        key = [F.lit(0).cast("long").alias(c) for c in ("a", "b")]
        root = root.select(*key, F.lit(total["root"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
                           F.lit(None).cast("long").alias("parent_conv_id"), F.lit(total["n"]).cast("long").alias("n_convs"), *SUMS)
        out = reduce(DataFrame.unionByName, [root, *[
            d.select("a", "b", F.col("rep").alias("conv_id"), "depth",
                     F.when(F.col("depth") == 1, F.lit(total["root"])).otherwise(F.col("parent_rep")).cast("long").alias("parent_conv_id"),
                     "n_convs", *SUMS) for d in done]])
    none = hashlib.sha256().hexdigest()
    out = out.join(ends(links), ["a", "b"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))).drop("a", "b")
    out, _ = stage(out, "trie")
    scratch.drop(spark)
    return out
