"""Document fingerprints by SpotSigs.

Words are runs of letters and digits, lower-cased. Every occurrence of an
anchor (a common function word) starts a chain: the anchor and the next
``CHAIN`` content words (words that are no anchors) after it; a chain cut by
the text's end keeps what it has. The fingerprint is the set of the chains'
32-bit hashes, written as sorted hex numbers joined by dots. Where no anchor
stands among the last ``REACH`` words (lists, tables, the start of a text),
content words are anchors themselves; the rule is local, so an edit changes
the signatures around it and no others. No rule looks at a text's length: a
word appended changes the chains at the end only. Texts of a few words have
few chains, and their likeness is as coarse.

Likeness is the Jaccard coefficient of two sets. Sets are partitioned by
length, in steps of 1 / floor: two sets whose likeness reaches the floor have
lengths within that factor, hence equal or neighbouring partitions; others
are not compared and count as 0. Those that are compared are pruned by the
same bound while their sorted hashes are counted out. A floor of 0 (the
default) compares everything exactly.

``near_duplicates`` finds the classes of documents linked by a likeness of
``THRESHOLD`` or more. Equal sets are one set. A set's signatures are put in
order of their frequency over all sets, rarest first; two sets that reach the
threshold share one of each other's n - ceil(threshold * n) + 1 rarest, so
each set goes to the cells of those. Cells of one set are dropped; a cell of
many sets is cut into pairs of tiles of neighbouring length partitions (see
``simhash_tiles.tile_groups``). Within a group sets are compared in order of
length until lengths are too far apart; pairs already connected are skipped.

``with_neighbour`` pairs every document with the next one in descending id
without a global sort in one task: ids are cut at approximate quantiles into
chunks (four per shuffle partition), the first document of each chunk is sent
to the chunk before it as well, and each chunk is read in order. Texts are
shuffled once.

Defined cases: a null text is empty; empty and word-less texts have the
empty fingerprint, alike (1) to each other and to nothing else; documents
with a null id come last, ordered by a hash of their text, in 64 chunks;
rows that repeat an id are ordered by that hash; a single document is its own
neighbour; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import FUNCTION_WORDS, Scratch, stage, whole_groups
from strata.llm.simhash_tiles import components, tile_groups

CHAIN = 2
THRESHOLD = 0.8
REACH = 6
TILE = 2048                # sets of a group
CHUNKS_PER_PARTITION = 4
NULL_CHUNKS = 64

_words = re.compile(r"[^\W_]+").findall


def signatures(text: str, anchors=FUNCTION_WORDS, chain: int = CHAIN) -> frozenset[int]:
    """Hashes of the text's chains."""
    content: list[str] = []
    starts: list[tuple[str, int]] = []
    since = REACH
    for w in _words(text.lower()):
        if w in anchors:
            starts.append((w, len(content)))
            since = 0
        else:
            content.append(w)
            since += 1
            if since > REACH:
                starts.append((w, len(content)))
    crc = zlib.crc32
    if chain == 2:
        content += ("", "")
        return frozenset([crc(f"{w} {content[k]} {content[k + 1]}".encode()) for w, k in starts])
    return frozenset([crc(" ".join((w, *content[k:k + chain])).encode()) for w, k in starts])


def to_string(found: frozenset[int]) -> str:
    return ".".join(["%08x" % h for h in sorted(found)])


def length_partition(n: int, floor: float) -> int:
    """Partition of a set length: two lengths within the factor 1 / floor lie
    in equal or neighbouring partitions."""
    return -1 if n == 0 else 0 if floor <= 0 else int(math.log(n) / -math.log(min(floor, 0.999)) + 1e-12)


def likeness(a: frozenset[int], b: frozenset[int], floor: float = 0.0) -> float:
    """Jaccard coefficient; 0 when it can't reach ``floor``."""
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    if abs(length_partition(len(a), floor) - length_partition(len(b), floor)) > 1:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    if len(a) < floor * len(b):
        return 0.0
    if floor > 0:           # misses the smaller set may have before the floor is out of reach
        need = math.ceil(floor * (len(a) + len(b)) / (1 + floor) - 1e-9)
        left = len(a) - need
        for h in a:
            left -= h not in b
            if left < 0:
                return 0.0
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared)


def _chunked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list]:
    """Rows with their chunk (0 first), and the first (id, hash) of each
    chunk that has rows: one entry per chunk, whatever the table's size."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    n = CHUNKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.filter("doc_id IS NOT NULL").select("doc_id").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.25 / n) if n > 1 else []
    cuts = np.unique(np.array(cuts, np.float64))

    @F.pandas_udf("int")
    def chunk_of(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        null = ids.isna().to_numpy()
        at = len(cuts) - np.searchsorted(cuts, ids.fillna(0).to_numpy(np.float64), side="right")    # larger ids first
        late = len(cuts) + 1 + ((hashes.to_numpy(np.int64).astype(object) + (1 << 63)) // ((1 << 64) // NULL_CHUNKS)) if null.any() else at
        return pd.Series(np.where(null, late, at).astype(np.int32))

    rows = rows.withColumn("chunk", chunk_of("doc_id", "h"))
    order = F.struct((-F.col("doc_id")).alias("d"), F.col("h").alias("h"))
    heads = sorted((r["chunk"], r["m"]["d"], r["m"]["h"]) for r in rows.groupBy("chunk").agg(F.min(order).alias("m")).collect())
    return rows, [(c, None if d is None else -d, h) for c, d, h in heads]


def with_neighbour(docs: DataFrame, visit, schema: str, *, id_col="doc_id", text_col="text") -> DataFrame:
    """``visit(rows)`` turns an iterator of (doc_id, text, next_id, next_text,
    is_next) into result tuples; is_next tells that the text met next is the
    neighbour just seen (a chunk's order), so work on it can be kept."""
    rows, heads = _chunked(docs, id_col, text_col)
    before = {heads[k][0]: heads[k - 1][0] for k in range(len(heads))}       # the first one's is the last: it wraps around
    spark = docs.sparkSession
    first = spark.createDataFrame([(c, d, h, before[c]) for c, d, h in heads], "chunk int, fid long, fh long, ahead int")
    own = rows.withColumn("guest", F.lit(0))
    sent = (rows.join(F.broadcast(first), "chunk")                           # a row per chunk
            .filter(F.col("doc_id").eqNullSafe(F.col("fid")) & (F.col("h") == F.col("fh")))
            .select(F.col("ahead").alias("chunk"), "doc_id", "text", "h").withColumn("guest", F.lit(1)))
    dealt = (own.select("chunk", "guest", "doc_id", "h", "text").unionByName(sent.select("chunk", "guest", "doc_id", "h", "text"))
             .repartition("chunk").sortWithinPartitions("chunk", "guest", F.col("doc_id").desc_nulls_last(), "h", "text"))
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pairs():
            last, done = None, False
            for b in batches:
                for c, guest, i, t in zip(b["chunk"].tolist(), b["guest"].tolist(), b["doc_id"].astype("Int64"), b["text"], strict=True):
                    i = None if i is pd.NA else int(i)
                    if last is not None and last[0] == c:
                        if not done:
                            yield last[1], last[2], i, t, not guest
                    if guest:
                        done = True
                        last = (c, i, t)
                    else:
                        done = False
                        last = (c, i, t)

        out = []
        for row in visit(pairs()):
            out.append(row)
            if len(out) == 2000:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    return dealt.mapInPandas(run, schema)


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, n_signatures int")


def fingerprint_edits(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """Every document's fingerprint, that of its edited text (the last half
    replaced by the start of the next document), and their likeness."""

    def visit(rows):
        kept = None
        for doc_id, text, _, next_text, goes_on in rows:
            own = kept if kept is not None else signatures(text)
            half = len(text) // 2
            edited = text[:len(text) - half] + next_text[:half]
            changed = own if edited == text else signatures(edited)
            following = signatures(next_text)
            yield (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_string(own), to_string(changed),
                   likeness(own, changed), likeness(own, following), len(own))
            kept = following if goes_on else None

    return with_neighbour(docs, visit, RESULT, id_col=id_col, text_col=text_col)


def signature_column(text: Column) -> Column:
    """array<long>: a text's signatures, sorted."""
    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([sorted(signatures(t)) for t in batch], dtype=object)
    return run(F.coalesce(text, F.lit("")))


def _group_links(sets: list[frozenset[int]], threshold: float) -> list[tuple[int, int]]:
    """Spanning links of the pairs that reach the threshold; ``sets`` in order
    of length."""
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for j, b in enumerate(sets):
        for i in range(j - 1, -1, -1):
            if len(sets[i]) < threshold * len(b):
                break                                     # all before are shorter still
            p, q = find(i), find(j)
            if p != q and likeness(sets[i], b, threshold) >= threshold:
                root[max(p, q)] = min(p, q)
                out.append((i, j))
    return out


def near_duplicates(docs: DataFrame, *, id_col="doc_id", text_col="text", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(doc_id, n_signatures, class_id), one row per input row; class_id is
    the smallest id of the documents linked with it, itself included."""
    scratch = Scratch()
    found, _ = stage(docs.select(F.col(id_col).alias("doc_id"), signature_column(F.col(text_col)).alias("sigs")).select(
        "doc_id", "sigs", F.size("sigs").alias("n_signatures"), F.xxhash64("sigs").alias("fp")), "spotsigs-found")
    sets = scratch.stage(found.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.first("sigs").alias("sigs")), "spotsigs-sets")
    rows = sets.select("fp", F.explode("sigs").alias("cell"))
    counts = scratch.stage(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "spotsigs-counts")
    n = F.size("order")
    steps = F.floor(-F.log(n.cast("double")) / F.log(F.lit(threshold)) + 1e-12).cast("int")         # length partition
    cells = (rows.join(counts, "cell").groupBy("fp").agg(F.array_sort(F.collect_list(F.struct("n", "cell"))).alias("order"))
             .select("fp", F.least(steps, F.lit(64)).alias("ones"),
                     F.explode(F.slice("order", F.lit(1), (n - F.ceil(threshold * n - 1e-9) + 1).cast("int"))).alias("o"))
             .filter("o.n > 1").select(F.col("o.cell").alias("cell"), "fp", "ones"))                 # a signature of one set links nothing
    cells = scratch.stage(cells, "spotsigs-cells")
    groups = tile_groups(cells, 1, tile, scratch).select("task", "fp").join(sets.select("fp", "sigs"), "fp")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, "task"):
            out = []
            for _, group in part.groupby("task", sort=False):
                fp, members = group["fp"].tolist(), [frozenset(x) for x in group["sigs"]]
                out += [(fp[i], fp[j]) for i, j in _group_links(members, threshold)]
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    links = (groups.withColumn("n", F.size("sigs")).repartition("task").sortWithinPartitions("task", "n", "fp")
             .mapInPandas(compare, "u long, v long").distinct())
    linked = components(links, scratch)
    rooted = scratch.stage(sets.select("fp", "least_id").join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")), "spotsigs-rooted")
    least = scratch.stage(rooted.groupBy("root").agg(F.min("least_id").alias("class_id")), "spotsigs-least")
    classes, _ = stage(rooted.join(least, "root").select("fp", "class_id"), "spotsigs-classes")
    scratch.drop(docs.sparkSession)
    return found.drop("sigs").join(classes, "fp").select("doc_id", "n_signatures", "class_id")
