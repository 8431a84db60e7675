"""Query over embeddings: op6 (exact top-k), and its SQL."""

from __future__ import annotations

from strata.llm import pivot_topk
from strata.llm.common import table


def op6_pivot_topk(spark, sf_dir):
    """The 5 highest inner products of every query vector."""
    return pivot_topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=5, every=50, scale=256)


SQL_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""

QUERIES = {"op6_pivot_topk": op6_pivot_topk}
ORACLE_SQL = {"op6_pivot_topk": SQL_TOPK}
