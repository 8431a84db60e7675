"""Bronze -> silver: cleaned, typed, one row per business key.

Each function is ``DataFrame -> DataFrame`` and lazy; counts are taken in the
same pass as the write (see ``plans.medallion``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import parse_timestamp
from strata.operators.cleaning import (
    distinct_rows, latest_per_key, positive, require_not_null, split_corrupt,
)
from strata.operators.quality import validate_schema
from strata.sources.readers import parse_json_lines
from strata.sources.schemas import CORRUPT_COL, EVENTS_CLEAN_COLUMNS, RAW_EVENT

EVENT_KEYS = ["event_id", "user_id", "session_id", "event_type"]
TRANSACTION_SCHEMA = ("transaction_id string, session_id string, user_id string, amount double, currency string, "
                      "transaction_timestamp timestamp")
USER_SCHEMA = "user_id string, signup_date date, device_type string, country string"
TRANSACTION_KEYS = ["transaction_id", "session_id", "user_id", "amount"]


def _as_timestamp(df: DataFrame, col: str) -> F.Column:
    if isinstance(df.schema[col].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.col(col).cast("timestamp")
    return parse_timestamp(col)


def _stamp(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("processing_timestamp", F.current_timestamp()) if stamp else df


def events_from_json(lines: DataFrame, text_col: str = "value"):
    """Parse raw JSON lines: (parsed rows, corrupt rows)."""
    parsed = parse_json_lines(lines, text_col, RAW_EVENT, CORRUPT_COL)
    return split_corrupt(parsed, CORRUPT_COL)


def events_clean(raw: DataFrame, stamp: bool = False, extra_cols=("value",)) -> DataFrame:
    """Null keys dropped, timestamp parsed, newest copy per event_id kept.

    Rows with a NULL timestamp are kept (the reference keeps them); they are
    ordered last by the dedup and left out of session paths.
    """
    missing = validate_schema(raw, EVENTS_CLEAN_COLUMNS)
    if missing:
        raise ValueError(f"events input is missing columns: {sorted(missing)}")
    df = require_not_null(raw, EVENT_KEYS)
    df = df.withColumn("event_timestamp", _as_timestamp(df, "event_timestamp"))
    keep = EVENTS_CLEAN_COLUMNS + [c for c in extra_cols if c in df.columns]
    # ties are broken on the scalar columns: the payload stays out of the
    # order, so a reader that does not ask for it never parses it
    scalars = [c for c in keep if c not in ("event_id", "event_timestamp", "event_details")]
    df = latest_per_key(df.select(*keep), "event_id", "event_timestamp", tiebreak=scalars)
    return _stamp(df, stamp)


def transactions_clean(raw: DataFrame, stamp: bool = False) -> DataFrame:
    df = require_not_null(raw, TRANSACTION_KEYS)
    df = positive(df, "amount")
    df = df.withColumns({
        "transaction_timestamp": _as_timestamp(df, "transaction_timestamp"),
        "currency": F.trim("currency"),
    })
    cols = ["transaction_id", "session_id", "user_id", "amount", "currency", "transaction_timestamp"]
    df = latest_per_key(df.select(*cols), "transaction_id", "transaction_timestamp")
    return _stamp(df, stamp)


def _users_typed(raw: DataFrame) -> DataFrame:
    return require_not_null(raw, ["user_id"]).select(
        "user_id",
        F.to_date(_as_timestamp(raw, "signup_date")).alias("signup_date"),
        F.trim("device_type").alias("device_type"),
        F.trim("country").alias("country"),
    )


def users_distinct(raw: DataFrame) -> DataFrame:
    """The reference's users step: non-null id, date, trimmed, full-row distinct."""
    return distinct_rows(_users_typed(raw))


def users_dim(raw: DataFrame, stamp: bool = False) -> DataFrame:
    """One row per user: among differing rows of one user the latest signup
    wins, ties broken on the other columns (a user with two rows would
    otherwise duplicate every one of their sessions in gold)."""
    df = _users_typed(raw)
    # one shuffle: the per-user pick also removes exact duplicates
    df = latest_per_key(df, "user_id", "signup_date")
    return _stamp(df, stamp)
