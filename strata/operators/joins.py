"""Joins of the gold layer, shaped for skew and size.

* ``broadcast_if_small`` broadcasts a dimension only after its row count
  (times the schema's row width) is checked against a limit; beyond the
  limit the join stays a shuffle join, where AQE splits skewed partitions.
* ``left_join_fanout`` is a left join whose right side may hold hot keys
  (many rows per key). It is planned as inner join + anti join: AQE can
  split a skewed right side of an inner join, not of a left outer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed defaults for the broadcast check.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024


def _type_width(t) -> int:
    from pyspark.sql import types as T
    if isinstance(t, (T.StringType, T.BinaryType)):
        return 64
    if isinstance(t, T.StructType):
        return sum(_type_width(f.dataType) for f in t.fields)
    if isinstance(t, (T.ArrayType, T.MapType)):
        return 256
    if isinstance(t, (T.IntegerType, T.DateType, T.FloatType)):
        return 4
    if isinstance(t, T.DecimalType):
        return 16
    return 8


def row_width(df: DataFrame) -> int:
    """Rough bytes per row from the schema (strings at 64 B) plus row overhead."""
    return 16 + sum(_type_width(f.dataType) for f in df.schema.fields)


def broadcast_if_small(dim: DataFrame, row_bound=None,
                       max_rows: int = MAX_BROADCAST_ROWS,
                       max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(dim)`` if its size is proven under the limits, else ``dim``.

    ``row_bound`` is a cheaper frame with at least as many rows as ``dim``
    (e.g. the source table a one-row-per-key dimension is built from), or a
    list of frames whose row counts together bound it (e.g. both sides of a
    full outer join); counting a parquet table reads only footers.
    """
    bounds = row_bound if isinstance(row_bound, (list, tuple)) else [row_bound if row_bound is not None else dim]
    n = sum(b.count() for b in bounds)
    if n <= max_rows and n * row_width(dim) <= max_bytes:
        return F.broadcast(dim)
    return dim


def left_join_fanout(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """``left ⟕ right`` on ``keys`` where ``left`` has one row per key and
    ``right`` may have many (every match is kept: fan-out)."""
    keys = list(keys)
    extra = [c for c in right.columns if c not in keys]
    matched = left.join(right, keys, "inner")
    right_keys = right.select(*keys).distinct()
    types = {f.name: f.dataType for f in right.schema.fields}
    unmatched = left.join(right_keys, keys, "left_anti").select(
        *left.columns, *[F.lit(None).cast(types[c]).alias(c) for c in extra])
    return matched.select(*left.columns, *extra).unionByName(unmatched)


def first_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """Earliest row per key by ``order_cols`` ascending (NULLs last)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def orphans(child: DataFrame, parent: DataFrame, keys) -> DataFrame:
    """Rows of ``child`` whose key has no row in ``parent``."""
    keys = list(keys)
    return child.join(parent.select(*keys).distinct(), keys, "left_anti")
