"""Row-level cleaning: null keys, positive amounts, corrupt split, dedup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.sources.schemas import CORRUPT_COL


def require_not_null(df: DataFrame, cols) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL (one pushed-down conjunction)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) > 0)


def split_corrupt(df: DataFrame, corrupt_col: str = CORRUPT_COL):
    """(valid rows without the corrupt column, corrupt rows as raw text).

    Works on frames whose corrupt column comes from ``from_json`` (see
    ``sources.readers.read_events_json``). If the column is absent there is
    nothing corrupt.
    """
    if corrupt_col not in df.columns:
        return df, df.limit(0).select(F.lit(None).cast("string").alias(corrupt_col))
    valid = df.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = df.filter(F.col(corrupt_col).isNotNull()).select(corrupt_col)
    return valid, bad


def latest_per_key(df: DataFrame, keys, order_col: str, tiebreak=None) -> DataFrame:
    """Keep the newest row per key (``order_col`` descending, NULLs last).

    Ties on ``order_col`` are broken by the remaining columns, descending, so
    the survivor does not depend on arrival order. ``row_number() = 1`` is
    planned with a partial group limit before the shuffle, so a key with
    many copies is cut down to one row per map task before it moves.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if tiebreak is None:
        fields = df.schema.fields
        tiebreak = [f.name for f in fields if f.name not in keys and f.name != order_col
                    and _orderable(f.dataType)]
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _orderable(dt) -> bool:
    from pyspark.sql import types as T
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (partial distinct on every map task first)."""
    return df.distinct()
