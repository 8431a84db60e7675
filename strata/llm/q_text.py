"""Queries over document texts: op2 (quality), op3 (byte-level BPE),
op4 (toxicity), op5 (SimHash near-dedup), op7 (fingerprints), op11 (secrets)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from strata.llm import bpe_bitmap, secret_novelty, simhash_tiles, spotsigs, toxic_segments, weak_quality
from strata.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"
TOXIC_FROM = 0.3


def op2_weak_quality(spark, sf_dir):
    """Quality score of every document, and whether the filter keeps it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = weak_quality.fit(docs)
    scored = docs.select("doc_id", weak_quality.score(spark, F.col("text"), model).alias("score"))
    return scored.withColumn("kept", (F.col("score") >= weak_quality.KEEP_FROM).cast("int"))


def op3_bpe_round_trip(spark, sf_dir):
    """Token count and digests of every document's ids and decoded bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_bitmap.round_trip(spark, F.col("text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return docs.select("doc_id", coded.alias("c")).select("doc_id", "c.*")


def held_out(id_col="doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity_model(spark, docs, sf_dir):
    """Fitted on the labelled rows of ``docs`` outside the held-out fold."""
    labels = toxic_segments.training_rows(table(spark, sf_dir, "labels"), hold_out=held_out())
    return toxic_segments.fit(docs, labels)


def op4_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(spark, docs, sf_dir)
    scored = docs.select("doc_id", toxic_segments.score(spark, F.col("text"), model).alias("s"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.col("s.score").alias("score"),
        (F.col("s.score") >= TOXIC_FROM).cast("int").alias("predicted"),
        F.col("s.n_words").alias("n_words"), F.col("s.n_passages").alias("n_passages"))


def op5_simhash_dedup(spark, sf_dir):
    """Fingerprint and component of every document: 3-word shingles, radius 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classes = simhash_tiles.dedup_classes(docs, shingle=3, radius=2)
    return classes.select("doc_id", simhash_tiles.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op7_spotsigs(spark, sf_dir):
    """Fingerprints of every document and its edited text."""
    return spotsigs.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_secret_scan(spark, sf_dir):
    """Spans of secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = secret_novelty.identifiers(docs)
    found = docs.select("doc_id", secret_novelty.scan(spark, F.col("text"), words).alias("s")).select("doc_id", "s.spans")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secret_novelty.KINDS],
        F.sha2(secret_novelty.joined(base), 256).alias("base_sha256"), secret_novelty.joined(F.col("spans")).alias("spans"))


QUERIES = {"op2_weak_quality": op2_weak_quality, "op3_bpe_round_trip": op3_bpe_round_trip, "op4_toxicity": op4_toxicity,
           "op5_simhash_dedup": op5_simhash_dedup, "op7_spotsigs": op7_spotsigs,
           "op11_secret_scan": op11_secret_scan}
ORACLE_SQL: dict[str, str] = {}
