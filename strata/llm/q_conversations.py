"""Queries over conversations: op12 (prefix trie) and op13 (structure repair)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import prefix_trie, structure_repair
from strata.llm.common import table

GRAFT_OF, GRAFT_TURNS = 100, 6


def _crc(text):
    return F.crc32(text.cast("binary"))


def op12_prefix_trie(spark, sf_dir):
    """Every node of the prefix trie of the rebuilt conversations: the first
    crc32(id) % 6 turns come from the conversation id - id % 100."""
    own = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    rebuilt = prefix_trie.rebuild(own, source=conv - conv % GRAFT_OF, n_first=_crc(conv.cast("string")) % GRAFT_TURNS, most=GRAFT_TURNS - 1)
    return prefix_trie.trie(rebuilt)


# crc32 of a decimal number, bit by bit: a step of 0 or more takes in a byte,
# a step of -1 shifts out a bit
SQL_TRIE = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384 * (s & 1)) END), 4294967295) % {GRAFT_TURNS} AS h
  FROM (SELECT DISTINCT conv_id FROM r)
), own AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
    sha256(concat(length(role), ':', role, text))) AS k FROM r
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, k, role, text FROM c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % {GRAFT_OF} AND k <= h
  UNION ALL SELECT conv_id, 1, k, role, text FROM own JOIN c USING (conv_id) WHERE k > h
), prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS n_chars,
    sha256(string_agg(concat(length(role), ':', role, length(text), ':', text), '') OVER w) AS p
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), ends AS (
  SELECT p, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM prefixes WHERE (conv_id, depth) IN (SELECT conv_id, max(depth) FROM prefixes GROUP BY conv_id) GROUP BY p
), nodes AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_chars) AS n_chars FROM prefixes GROUP BY p, depth
), linked AS (
  SELECT n.*, u.p AS parent FROM nodes n LEFT JOIN prefixes u ON u.conv_id = n.conv_id AND u.depth = n.depth - 1
), children AS (
  SELECT parent AS p, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT a.p, count(*) FILTER (WHERE k.p IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.n_chars) AS saved_tokens
  FROM nodes n LEFT JOIN children k USING (p) JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.p
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM linked n LEFT JOIN nodes u ON u.p = n.parent LEFT JOIN children k ON k.p = n.p JOIN below b ON b.p = n.p LEFT JOIN ends e ON e.p = n.p
"""


def damaged(rows):
    """Conversations with faults by crc32('id:turn') % 20 (nulls: one space):
    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats
    the row, 4 makes its role user. ``present`` is false for dropped rows, so
    that their conversation is still known."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = _crc(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fault.alias("fault"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") <= 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fault") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"))


def op13_structure_repair(spark, sf_dir):
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    rows = damaged(table(spark, sf_dir, "conversations"))
    return structure_repair.repair(rows, present=F.col("present"))


QUERIES = {"op12_prefix_trie": op12_prefix_trie, "op13_structure_repair": op13_structure_repair}
ORACLE_SQL = {"op12_prefix_trie": SQL_TRIE}
