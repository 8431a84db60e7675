"""Training-data pipeline over ``documents``: five stages, each written as
Parquet and read again as the next one's input.

1. toxicity: documents whose toxicity score is 0.3 or more go
2. quality: documents that the weak-label classifier rejects go
3. near_dedup: one document of each SimHash component stays
4. mix: documents repeated (or left out) by the source mix
5. bpe: every remaining row encoded and decoded

All but the last return the columns of documents. Rows are judged one by
one: null and repeated ids are handled as the operators define. Repeated
rows of a kept document count as one document in stage 3.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe_bitmap, simhash_tiles, toxic_segments, waterfill_mix, weak_quality
from strata.llm.common import Scratch, drop, stage
from strata.llm.q_text import RANKS, TOXIC_FROM, toxicity_model


# tables that the rows of the stage last called still read; ``run`` drops them
# when those rows are written
_read = Scratch()


def _free_name(docs: DataFrame, name: str) -> str:
    """A column name that the input does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _where(docs: DataFrame, values: dict[str, Column], condition) -> DataFrame:
    """Rows for which ``condition(names)`` holds over added columns, without them."""
    names = {k: _free_name(docs, f"stage_{k}") for k in values}
    return docs.withColumns({names[k]: c for k, c in values.items()}).filter(condition(names)).select(*[docs[c] for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents scored below 0.3; fitted on the labelled rows still here."""
    model = toxicity_model(spark, docs.select("doc_id", "text"), sf_dir)
    return _where(docs, {"toxicity": toxic_segments.score(spark, F.col("text"), model)},
                  lambda n: F.col(n["toxicity"])["score"] < TOXIC_FROM)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the weak-label classifier takes for good."""
    model = weak_quality.fit(docs.select("doc_id", "text"))
    return _where(docs, {"quality": weak_quality.score(spark, F.col("text"), model)},
                  lambda n: F.col(n["quality"]) >= weak_quality.KEEP_FROM)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each component (null ids
    last; of several texts with that id, the one of the smallest hash); rows
    that repeat its id and text are cut to one."""
    mine = Scratch()
    classes = simhash_tiles.dedup_classes(docs.select("doc_id", "text"), shingle=3, radius=2, kept=mine)
    order = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    kept = _read.stage(classes.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.id").alias("id"), F.col("k.hash").alias("hash")), "pipeline-kept")
    again = classes.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = _read.stage(again.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")), "pipeline-repeated")
    mine.drop(spark)
    # rows in one column, so that none of their names can clash
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("own_id"),
                       F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("own_hash"))
    same = lambda t: F.col("own_id").eqNullSafe(t["id"]) & (F.col("own_hash") == t["hash"])
    rows = rows.join(kept, same(kept), "left_semi")
    if again.limit(1).count():
        once = rows.join(again, same(again), "left_semi").dropDuplicates(["own_id", "own_hash"])
        rows = rows.join(again, same(again), "left_anti").unionByName(once)
    return rows.select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the remaining documents takes it
    (0 to 3 times)."""
    return waterfill_mix.repeat_by_mix(docs, weight_cycle=(1, 2, 3), max_epochs=3)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every row's ids and decoded bytes."""
    coded = bpe_bitmap.round_trip(spark, F.col("text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return docs.select("doc_id", coded.alias("coded")).select("doc_id", "coded.*")


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_dedup", near_dedup), ("mix", mix), ("bpe", bpe)]

# Model fits, SimHash components and byte-pair merges can't be said in SQL;
# tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, apply in STAGES:
        docs, path = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
        _read.drop(spark)
        if before:
            drop(spark, before)         # the stage before is written and no longer read
        before = path
    return docs
