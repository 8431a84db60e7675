"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from strata.llm import q_conversations, q_native, q_pages, q_text, q_vectors

_PARTS = (q_pages, q_text, q_vectors, q_native, q_conversations)

QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()} | {"pipeline": corpus_pipeline.run}
ORACLE_SQL = {k: v for part in _PARTS for k, v in part.ORACLE_SQL.items()}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
