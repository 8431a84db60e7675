"""Mixing sources to target weights: capped water-filling.

Every source has a weight and a size (its words). The mix's total is shared
by weight; a source whose share exceeds ``max_epochs`` times its size is
clamped there, and the excess is shared again by weight among the others,
until no share is above its clamp. Per round only three sums leave the
cluster. Each document is then taken a whole number of times (the whole part
of target / size of its source), and a seeded selection of documents once
more, so that the words taken land within half a document of the target.

The selection is a prefix of the source's documents in a seeded order (md5
of id and seed, then id, size and text hash), so the whole mix is a plan of
one row per source: whole repetitions and the last document of the prefix.
The prefix ends in one of 4096 hash buckets, found from (source, bucket) sums;
only that bucket is ordered, so a source that holds a third of all rows is
never sorted in one task. Rows that repeat (id, size) are counted before they
are ordered. Where the prefix ends among them, their text hashes are cut in
the same two steps (4096 buckets of hashes, counts by hash); where it ends
among rows of one hash, these are written once, and their places in the
written partitions say which of them are taken. So an id that holds a third
of all rows doesn't meet in one task either.

Defined cases: a null or empty text has size 0; null sources are one source,
ordered last; a null id is replaced by the text's md5 in the seeded order;
rows that repeat id (or a null id and text) are sized and taken one by one;
an empty table gives an empty result; a source of size 0 has target 0.
Input columns other than id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch, drop, hint_if_small, stage

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_BITS = 12           # 4096 hash buckets per source
_HASH_BITS = 60


def seeded_order(id_col="doc_id", text_col="text", seed: str = "mix") -> Column:
    """A 60-bit number that orders the documents."""
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    return F.conv(F.substring(F.md5(F.concat(key, F.lit("|" + seed))), 1, _HASH_BITS // 4), 16, 10).cast("long")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def document_sizes(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source",
                   seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, u, h): words of the text, the seeded order, and
    the text's hash."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"),
        seeded_order(id_col, text_col, seed).alias("u"), text_hash(F.col(text_col)).alias("h"))


def rank_sources(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``rank`` (from 0, by code point, null last) without one global
    window: position in a range-sorted partition plus the rows of the
    partitions before it (one row per partition)."""
    mid = F.monotonically_increasing_id()
    placed = scratch.stage(
        sources.sort(F.col("source").asc_nulls_last())
        .withColumn("part", F.shiftright(mid, 33)).withColumn("at", mid.bitwiseAND((1 << 33) - 1)),
        "mix-ranked")
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return placed.join(before, "part").select("source", "source_size", (F.col("before") + F.col("at")).alias("rank"))


def fill_targets(sources: DataFrame, *, total: float | None = None, max_epochs: int = 3) -> DataFrame:
    """``sources`` (source, source_size, weight) with its ``target``.

    ``total`` words are shared (default: the sum of all sizes). A source is
    clamped when its share weight * left / open weight is above
    max_epochs * size; the loop ends when no further source is clamped.
    """
    cap = F.lit(max_epochs) * F.col("source_size")
    total = total if total is not None else (sources.agg(F.sum("source_size")).first()[0] or 0)
    left, open_weight, n_clamped = total, None, -1
    clamped = F.lit(False)
    while True:
        row = sources.agg(
            F.sum(F.when(~clamped, F.col("weight"))).alias("w"),
            F.sum(F.when(clamped, cap)).alias("c"),
            F.sum(clamped.cast("long")).alias("n")).first()
        open_weight, left = row["w"] or 0, total - (row["c"] or 0)
        if (row["n"] or 0) == n_clamped or not open_weight:
            break
        n_clamped = row["n"] or 0
        clamped = clamped | (F.col("weight") * F.lit(left).cast("double") > cap.cast("double") * F.lit(open_weight))
    # as doubles, like the clamping above: an int weight times an int total overflows from 2**31 / weight words on
    share = F.col("weight") * F.lit(left).cast("double") / F.lit(float(open_weight or 1))
    return sources.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(share))


_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _known(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(_LEAST))


def _first_reaching(counts: DataFrame, group: str, order: str, wanted: str, *, beyond: bool = False) -> DataFrame:
    """The first row of each ``group``, by ``order``, whose running sum of
    ``n`` reaches (or is beyond) ``wanted``; with ``base``, the sum before it."""
    upto = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = counts.withColumn("end", F.sum("n").over(upto))
    return (ends.filter(F.col("end") > F.col(wanted) if beyond else F.col("end") >= F.col(wanted))
            .groupBy(group).agg(F.min(F.struct(order, (F.col("end") - F.col("n")).alias("base"), "n")).alias("cut"), F.first(wanted).alias(wanted))
            .select(group, wanted, f"cut.{order}", "cut.base", "cut.n"))


def _hash_cuts(sized: DataFrame, ends: DataFrame, scratch: Scratch) -> DataFrame:
    """(h_source, last_h, n_of_last) for the sources whose prefix ends among
    rows of one (id, size): the last text hash taken once more, and how many
    of the rows with that hash are; null for all of them."""
    open_ends = ends.filter("k < n").select(F.col("cut_source").alias("s"), "last_u", "last_id", "last_size", "k")
    tied = (sized.join(hint_if_small(open_ends, open_ends.count()), F.col("source").eqNullSafe(F.col("s")) & (F.col("u") == F.col("last_u"))
                       & (_known(F.col("doc_id")) == F.col("last_id")) & (F.col("size") == F.col("last_size")))
            .select("s", "k", "h", F.shiftright("h", 64 - BUCKET_BITS).alias("part")))
    counts = scratch.stage(tied.groupBy("s", "k", "part").agg(F.count(F.lit(1)).alias("n")), "mix-hash-buckets")
    cuts = scratch.stage(_first_reaching(counts, "s", "part", "k").select(
        F.col("s").alias("c"), F.col("part").alias("cut"), (F.col("k") - F.col("base")).alias("left")), "mix-hash-cuts")
    inside = (tied.join(hint_if_small(cuts, cuts.count()), F.col("s").eqNullSafe(F.col("c")) & (F.col("part") == F.col("cut")))
              .groupBy("s", "left", "h").agg(F.count(F.lit(1)).alias("n")))
    n_of = F.col("left") - F.col("base")
    return _first_reaching(inside, "s", "h", "left").select(
        F.col("s").alias("h_source"), F.col("h").alias("last_h"), F.when(n_of < F.col("n"), n_of).alias("n_of_last"))


def mix_plan(sized: DataFrame, *, weight_cycle=(1, 2, 3), total: float | None = None, max_epochs: int = 3) -> tuple[DataFrame, int]:
    """One row per source of ``sized`` (a written table of document_sizes):
    plan_source, source_size, target, whole, last_u, last_id, last_size,
    last_h (the last document taken once more), n_of_last (how many of the
    rows alike in all these are; null for all); and the number of sources."""
    scratch = Scratch()
    sources = scratch.stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    cycle = F.array(*[F.lit(w) for w in weight_cycle])
    weighted = scratch.stage(rank_sources(sources, scratch).withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weight_cycle) + 1).cast("int"))), "mix-weights")
    targets = fill_targets(weighted, total=total, max_epochs=max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.select("source", "source_size", "target", F.floor(ratio).cast("long").alias("whole"))
    targets = targets.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))

    sized = sized.withColumn("bucket", F.shiftright("u", _HASH_BITS - BUCKET_BITS))
    sums = scratch.stage(sized.groupBy("source", "bucket").agg(F.sum("size").alias("n")), "mix-buckets")
    sums = sums.withColumnRenamed("source", "s").join(targets.select("source", "extra"), F.col("s").eqNullSafe(F.col("source")))
    cuts = scratch.stage(_first_reaching(sums, "source", "bucket", "extra", beyond=True).select(
        F.col("source").alias("cut_source"), F.col("bucket").alias("cut"), "base", "extra"), "mix-cuts")
    n_sources = cuts.count()
    # rows that repeat (id, size) are one row with their number
    inside = (sized.join(hint_if_small(cuts, n_sources), F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("bucket") == F.col("cut")))
              .groupBy("cut_source", "base", "extra", "u", _known(F.col("doc_id")).alias("id"), "size").agg(F.count(F.lit(1)).alias("n")))
    order = Window.partitionBy("cut_source").orderBy("u", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size, n = F.col("size"), F.col("n")
    inside = inside.withColumn("before", F.col("base") + F.sum(n * size).over(order) - n * size)
    fits = lambda j: F.col("before") + j * size - size / 2 <= F.col("extra")
    guess = F.least(n, F.greatest(F.lit(0), F.floor((F.col("extra") - F.col("before")) / size + 0.5).cast("long")))
    # the division may round: one more or less is tried as well
    k = (F.when(size == 0, F.when(fits(F.lit(0)), n).otherwise(0))
         .otherwise(F.when((F.col("guess") < n) & fits(F.col("guess") + 1), F.col("guess") + 1)
                    .when((F.col("guess") > 0) & ~fits(F.col("guess")), F.col("guess") - 1).otherwise(F.col("guess"))))
    taken = (inside.filter("extra > 0").withColumn("guess", F.when(size > 0, guess)).withColumn("k", k).filter("k > 0")
             .groupBy(F.col("cut_source").alias("t")).agg(F.max(F.struct("u", "id", "size", "k", "n")).alias("last")))
    before_cut = F.when(F.col("extra") > 0, F.shiftleft("cut", _HASH_BITS - BUCKET_BITS) - 1).otherwise(F.lit(-1))
    ends = scratch.stage(cuts.join(taken, F.col("cut_source").eqNullSafe(F.col("t")), "left").select(
        "cut_source", F.coalesce("last.u", before_cut).alias("last_u"), F.coalesce("last.id", F.lit(_MOST)).alias("last_id"),
        F.coalesce("last.size", F.lit(_MOST)).alias("last_size"), "last.k", "last.n"), "mix-ends")
    if ends.filter("k < n").limit(1).count():
        ends = ends.join(_hash_cuts(sized, ends, scratch), F.col("cut_source").eqNullSafe(F.col("h_source")), "left")
    else:
        ends = ends.withColumns({"last_h": F.lit(None).cast("long"), "n_of_last": F.lit(None).cast("long")})
    plan, _ = stage(
        targets.join(ends, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .select(F.col("source").alias("plan_source"), "source_size", "target", "whole",
                F.coalesce("last_u", F.lit(-1)).alias("last_u"), F.coalesce("last_id", F.lit(_LEAST)).alias("last_id"),
                F.coalesce("last_size", F.lit(_MOST)).alias("last_size"), F.coalesce("last_h", F.lit(_MOST)).alias("last_h"), "n_of_last"), "mix-plan")
    scratch.drop(sized.sparkSession)
    return plan, plan.count()


def with_copies(rows: DataFrame, plan: DataFrame, n_sources: int, *, source: str, u: str, doc_id: str, size: Column, h: Column) -> DataFrame:
    """``rows`` with their plan row and ``copies``, how often each is taken."""
    u, doc_id = F.col(u), _known(F.col(doc_id))
    rows = rows.join(hint_if_small(plan, n_sources), F.col(source).eqNullSafe(F.col("plan_source")))
    # size and hash are looked at beside the last id only
    at_id = (u == F.col("last_u")) & (doc_id == F.col("last_id"))
    more = (u < F.col("last_u")) | ((u == F.col("last_u")) & (doc_id < F.col("last_id"))) | (
        at_id & ((size < F.col("last_size")) | ((size == F.col("last_size")) & (h <= F.col("last_h")))))
    copies = F.col("whole") + more.cast("long")
    ties = plan.filter("n_of_last IS NOT NULL")
    n_ties = ties.count()
    if not n_ties:
        return rows.withColumn("copies", copies)
    tie = F.col("n_of_last").isNotNull() & at_id & (size == F.col("last_size")) & (h == F.col("last_h"))
    tied, _ = stage(rows.filter(tie).withColumn("place", F.monotonically_increasing_id()), "mix-tied")
    scratch = Scratch()
    place = tied.select(F.col("plan_source").alias("s"), F.col("n_of_last").alias("k"), "place", F.shiftright("place", 33).alias("part"))
    counts = scratch.stage(place.groupBy("s", "k", "part").agg(F.count(F.lit(1)).alias("n")), "mix-tied-counts")
    cuts = scratch.stage(_first_reaching(counts, "s", "part", "k").select(
        F.col("s").alias("c"), F.col("part").alias("cut"), (F.col("k") - F.col("base")).alias("left")), "mix-tied-cuts")
    inside = place.join(hint_if_small(cuts, n_ties), F.col("s").eqNullSafe(F.col("c")) & (F.col("part") == F.col("cut")))
    at = F.row_number().over(Window.partitionBy("s").orderBy("place"))           # rows of one written partition
    last, _ = stage(inside.withColumn("at", at).filter("at = left").select("s", F.col("place").alias("last_place")), "mix-tied-last")
    scratch.drop(rows.sparkSession)
    dealt = (tied.join(hint_if_small(last, n_ties), F.col("plan_source").eqNullSafe(F.col("s")))
             .withColumn("copies", F.col("whole") + (F.col("place") <= F.col("last_place")).cast("long")))
    return rows.filter(~tie).withColumn("copies", copies).unionByName(dealt.drop("place", "s", "last_place"))


def mix_copies(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source",
               weight_cycle=(1, 2, 3), total: float | None = None, max_epochs: int = 3,
               seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target,
    ``copies`` (times the mix takes it)."""
    sized, _ = stage(document_sizes(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed), "mix-sizes")
    plan, n = mix_plan(sized, weight_cycle=weight_cycle, total=total, max_epochs=max_epochs)
    return (with_copies(sized, plan, n, source="source", u="u", doc_id="doc_id", size=F.col("size"), h=F.col("h"))
            .select("doc_id", "source", "size", "source_size", "target", "copies"))


def repeat_by_mix(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source",
                  weight_cycle=(1, 2, 3), total: float | None = None, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    sized, sizes = stage(document_sizes(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed), "mix-sizes")
    plan, n = mix_plan(sized, weight_cycle=weight_cycle, total=total, max_epochs=max_epochs)
    drop(docs.sparkSession, sizes)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")       # one column: nothing of docs can clash
    rows = docs.select(row, seeded_order(id_col, text_col, seed).alias("u"), docs[id_col].alias("id"), docs[source_col].alias("src"))
    text = F.col("row").getField(text_col)
    return (with_copies(rows, plan, n, source="src", u="u", doc_id="id", size=words(text), h=text_hash(text))
            .withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .select("row.*"))
