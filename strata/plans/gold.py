"""Silver -> gold: the wide per-session table ``user_session_analysis``.

Plan shape (checked with ``explain``):

* sessions: partial+final aggregate, one shuffle on (session_id, user_id);
* purchases: earliest purchase per session, a shuffle on the same keys, so
  the sessions/purchases join reuses both partitionings (no extra shuffle);
* users: broadcast when the size check passes, else a shuffle join whose
  skewed (hot-user) partitions AQE splits.

``gold_fanout`` keeps every purchase of a session (one row per purchase),
as a plain left join would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalar import is_present, seconds_after_or_null, to_money, to_ntz
from strata.operators.joins import broadcast_if_small, first_per_key, left_join_fanout
from strata.operators.sessions import SESSION_KEYS, session_aggregate
from strata.sources.schemas import GOLD_COLUMNS

# Fixed values written into every gold row.
DATA_VERSION = 1
SOURCE_SYSTEM = "local_pipeline"


def _purchases(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "session_id", "user_id", "transaction_id",
        to_money("amount").alias("transaction_amount"),
        F.col("currency").alias("transaction_currency"),
        "transaction_timestamp")


def _users(users: DataFrame, users_bound: DataFrame | None) -> DataFrame:
    u = users.select("user_id", "signup_date", "device_type", "country")
    return broadcast_if_small(u, users_bound)


def _finish(df: DataFrame, stamp: bool) -> DataFrame:
    out = df.select(
        "user_id", "session_id", "signup_date", "device_type", "country",
        "session_start_time", "session_end_time", "session_duration_seconds", "session_date",
        F.col("total_events").cast("int").alias("total_events"),
        "event_types", "first_event_type", "last_event_type",
        "transaction_id", "transaction_amount", "transaction_currency", "transaction_timestamp",
        is_present("transaction_id").alias("has_transaction"),
        seconds_after_or_null("transaction_timestamp", "session_start_time").alias("time_to_purchase_seconds"),
        F.current_timestamp().alias("processing_timestamp"),
        F.lit(DATA_VERSION).alias("data_version"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )
    return out if stamp else out.drop("processing_timestamp")


def user_session_analysis(events: DataFrame, transactions: DataFrame, users: DataFrame,
                          users_bound: DataFrame | None = None, stamp: bool = True,
                          with_path: bool = True) -> DataFrame:
    """One row per (session_id, user_id); the earliest purchase of the
    session by (timestamp, id) fills the transaction columns. Without the
    path (NULL), a session's row does not grow with the session."""
    sessions = session_aggregate(events, with_path=with_path)
    if not with_path:
        sessions = sessions.withColumn("event_types", F.lit(None).cast("array<string>"))
    first = first_per_key(_purchases(transactions), SESSION_KEYS,
                          ["transaction_timestamp", "transaction_id"])
    joined = sessions.join(first, SESSION_KEYS, "left")
    joined = joined.join(_users(users, users_bound), "user_id", "left")
    return _finish(joined, stamp)


def gold_fanout(events: DataFrame, transactions: DataFrame, users: DataFrame,
                users_bound: DataFrame | None = None, stamp: bool = True) -> DataFrame:
    """One row per (session, purchase); sessions without purchase once."""
    sessions = session_aggregate(events)
    joined = left_join_fanout(sessions, _purchases(transactions), SESSION_KEYS)
    joined = joined.join(_users(users, users_bound), "user_id", "left")
    return _finish(joined, stamp)


def comparable(gold: DataFrame) -> DataFrame:
    """Gold as compared with the SQL oracle: the path as one string,
    timestamps without zone, no audit column."""
    cols = []
    for c in GOLD_COLUMNS:
        if c == "processing_timestamp" or c not in gold.columns:
            continue
        if c == "event_types":
            cols.append(F.array_join("event_types", ",").alias("event_path"))
        elif c in ("session_start_time", "session_end_time", "transaction_timestamp"):
            cols.append(to_ntz(c).alias(c))
        else:
            cols.append(F.col(c))
    return gold.select(*cols)


def gold_metrics(gold: DataFrame) -> DataFrame:
    """(total_sessions, sessions_with_purchase, conversion_rate_pct), one
    pass; the rate is 0 for an empty table."""
    return gold.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if(F.col("has_transaction")).alias("sessions_with_purchase"),
    ).withColumn("conversion_rate_pct", F.coalesce(
        F.try_divide(F.col("sessions_with_purchase") * 100.0, F.col("total_sessions")), F.lit(0.0)))
