"""Registered queries over the given tables, each with its SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB
SQL over the same tables, registered as views). Output columns carry the
same names on both sides; timestamps are compared without zone, money as
DECIMAL or as a quotient of exact integers, paths as joined text.
"""

from strata.plans import (  # noqa: F401
    catalog_accounting, catalog_drift, catalog_features, catalog_gold, catalog_history, catalog_layout, catalog_paths, catalog_quality, catalog_scalar, catalog_silver, catalog_stateful, catalog_streaming,
    catalog_tables,
)
from strata.registry import ORACLE_SQL, QUERIES  # noqa: F401
