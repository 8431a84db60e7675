"""Queries op8 and op9 (DataFrame functions only) and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import license_join, waterfill_mix
from strata.llm.common import table


def op8_license_scan(spark, sf_dir):
    """License places and labels of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_join.scan(docs)
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
        F.size("matches").cast("long").alias("n_matches"))


_TEMPLATE_ROWS = ",\n  ".join(f"('{label}', '{text}')" for label, text in license_join.TEMPLATES)

SQL_LICENSE = rf"""
WITH templates AS (
  SELECT row_number() OVER () - 1 AS template, label, list_distinct(string_split(t, ' ')) AS tw,
    CAST({license_join.BLOCK_WORDS} * pow(2, greatest(0, ceil(log2(2 * len(string_split(t, ' ')) / {license_join.BLOCK_WORDS}.0)))) AS BIGINT) AS win
  FROM (VALUES
  {_TEMPLATE_ROWS}) AS v(label, t)
), w AS (
  SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), pos AS (
  SELECT k, unnest(words) AS a, unnest(range(len(words))) AS i FROM w
), seq AS (
  SELECT k, i, a, lead(a) OVER p AS b, lead(a, 2) OVER p AS c FROM pos WINDOW p AS (PARTITION BY k ORDER BY i)
), base AS (
  SELECT k, i, 'mit' AS label FROM seq WHERE a = 'mit' AND b = 'license'
  UNION ALL SELECT k, i, 'apache' FROM seq WHERE a = 'apache' AND b = 'license'
  UNION ALL SELECT k, i, 'gpl' FROM seq WHERE a = 'general' AND b = 'public' AND c = 'license'
), per_base AS (
  SELECT k, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_distinct(list(label)) AS base_labels
  FROM base GROUP BY k
), blocks AS (
  SELECT k, win, s // (win // 2) AS block, list_distinct(words[s + 1 : s + win]) AS bw
  FROM (SELECT k, words, win, unnest(range(0, greatest(1, len(words)), win // 2)) AS s
        FROM w, (SELECT DISTINCT win FROM templates) WHERE len(words) > 0)
), matches AS (
  SELECT k, block, label, len(list_intersect(bw, tw)) / len(tw) AS containment
  FROM blocks JOIN templates USING (win)
  WHERE len(list_intersect(bw, tw)) >= ceil({license_join.THRESHOLD} * len(tw) - 1e-9)
), per_match AS (
  SELECT k, count(*) AS n_matches, list_distinct(list(label)) AS found, max(containment) AS best FROM matches GROUP BY k
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(base_labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(found, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0) END::DOUBLE AS score,
  CAST(coalesce(n_matches, 0) AS BIGINT) AS n_matches
FROM w LEFT JOIN per_base USING (k) LEFT JOIN per_match USING (k)
"""


def op9_source_mix(spark, sf_dir):
    """The mix of all documents: targets by source, words taken by document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mix = waterfill_mix.mix_copies(docs, weight_cycle=(1, 2, 3), max_epochs=3)
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


SQL_MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) || '|mix'), 1, 15) AS BIGINT) AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, 3 * source_size AS cap,
    coalesce(sum(3 * source_size) OVER b, 0) AS cap_before, coalesce(sum(w) OVER b, 0) AS w_before,
    sum(source_size) OVER () AS total, sum(w) OVER () AS w_all
  FROM s
  WINDOW b AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT min_by(total - cap_before, w_before) AS rest, min_by(w_all - w_before, w_before) AS w_open, min(w_before) AS w_cut
  FROM o WHERE w * (total - cap_before) <= cap * (w_all - w_before)
), t AS (
  SELECT source, source_size,
    CASE WHEN w_before < coalesce(w_cut, 1e18) THEN CAST(cap AS DOUBLE) ELSE CAST(w * rest AS DOUBLE) / CAST(w_open AS DOUBLE) END AS target
  FROM o, level
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), r AS (
  SELECT d.*, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size AS extra,
    sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  CAST((whole + CASE WHEN extra > 0 AND upto - size / 2.0 <= extra THEN 1 ELSE 0 END) * size AS BIGINT) AS taken,
  CAST(whole + CASE WHEN extra > 0 AND upto - size / 2.0 <= extra THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM r
"""

QUERIES = {"op8_license_scan": op8_license_scan, "op9_source_mix": op9_source_mix}
ORACLE_SQL = {"op8_license_scan": SQL_LICENSE, "op9_source_mix": SQL_MIX}
