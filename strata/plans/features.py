"""Fraud features at transaction grain (the offline feature table).

Behaviour (trailing 24 h / 1 h, per user): sessions_24h, spent_24h,
distinct_event_types_24h (the given events carry no device or country; the
operator is generic over a column), transactions_last_hour. Velocity:
amount_deviation_from_avg (amount minus the mean of the user's earlier
amounts). Account: days_since_signup, lifetime_value (running total),
chargeback_rate (share of the user's orders with a returned line).

Money is summed as exact integer cents; every ratio is one division of
exact integers, so results do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalar import cents, score_band
from strata.operators.joins import broadcast_if_small
from strata.operators.windows import DAY, HOUR, running, trailing


# output column -> (frame, width, kind, input)
_FRAMES = {
    "sessions_24h": ("_sessions", DAY, "distinct", "session_id"),
    "distinct_event_types_24h": ("_types", DAY, "distinct", "event_type"),
    "spent_24h": ("_cents", DAY, "sum", "cents"),
    "transactions_last_hour": ("transactions_last_hour", HOUR, "count", "transaction_id"),
}


def behaviour(events: DataFrame, transactions: DataFrame, keep=(), with_running: bool = False,
              only=tuple(_FRAMES)) -> DataFrame:
    """Trailing-window features for every transaction, from one sweep over
    the events and transactions of each user. Columns in ``keep`` are
    carried through from the transactions. ``with_running``: the same sweep
    also adds the running cents total ``_cum`` and ``running_count`` of the
    user's transactions in (timestamp, transaction_id) order. ``only``: the
    features to compute; frames that are not asked for cost nothing."""
    keep = [c for c in keep if c not in ("transaction_id", "user_id")]
    types = {f.name: f.dataType for f in transactions.schema.fields}
    ev = events.select(
        "user_id", F.col("event_timestamp").alias("ts"), "session_id", "event_type",
        F.lit(None).cast("bigint").alias("cents"),
        F.lit(None).cast(types["transaction_id"]).alias("transaction_id"),
        *[F.lit(None).cast(types[c]).alias(c) for c in keep], F.lit(False).alias("_tx"))
    tx = transactions.select(
        "user_id", F.col("transaction_timestamp").alias("ts"), F.lit(None).cast("string").alias("session_id"),
        F.lit(None).cast("string").alias("event_type"), cents("amount").alias("cents"),
        "transaction_id", *keep, F.lit(True).alias("_tx"))
    # trailing frames as one linear sweep per (user, hour bucket): no sliding
    # frame re-aggregation, no replicated rows (see operators.windows)
    frames = {name: (width, kind, F.col(col)) for name, width, kind, col in (_FRAMES[c] for c in only)}
    values = {"sessions_24h": F.col("_sessions").cast("int"), "distinct_event_types_24h": F.col("_types").cast("int"),
              "spent_24h": F.coalesce(F.col("_cents"), F.lit(0)) / 100.0,
              "transactions_last_hour": F.col("transactions_last_hour")} if only else {}
    uses_events = any(c in ("sessions_24h", "distinct_event_types_24h") for c in only)
    running = {"_cum": F.col("cents"), "running_count": F.lit(1).cast("long")} if with_running else None
    out = trailing(ev.unionByName(tx) if uses_events else tx, "user_id", "ts", frames, bucket_seconds=HOUR, target=F.col("_tx"),
                   running=running, tiebreak="transaction_id")
    return out.select("transaction_id", "user_id", *keep, *(["_cum", "running_count"] if with_running else []),
                      *[values[c].alias(c) for c in only])


def add_velocity(tx: DataFrame) -> DataFrame:
    """Add running totals per user to transaction rows (needs
    transaction_id, user_id, transaction_timestamp, amount): lifetime_value
    (this and earlier transactions) and the deviation of the amount from the
    mean of earlier amounts (NULL for a user's first transaction)."""
    r = running(tx, "user_id", "transaction_timestamp", "transaction_id", {"_cum": cents("amount")})
    return _velocity_columns(r)


def _velocity_columns(r: DataFrame) -> DataFrame:
    """lifetime_value and amount_deviation_from_avg from the running cents
    total ``_cum`` and ``running_count`` (this and earlier transactions)."""
    prev_n = F.col("running_count") - 1
    prev_cents = F.col("_cum") - cents("amount")
    return (r.withColumn("lifetime_value", F.col("_cum") / 100.0)
            .withColumn("amount_deviation_from_avg",
                        F.when(prev_n > 0, (cents("amount") * prev_n - prev_cents) / (prev_n * 100.0)))
            .drop("_cum", "running_count"))


def velocity(transactions: DataFrame) -> DataFrame:
    tx = transactions.select("transaction_id", "user_id", "transaction_timestamp", "amount")
    return add_velocity(tx).select("transaction_id", "user_id", "lifetime_value", "amount_deviation_from_avg")


def chargeback_rate(orders: DataFrame, lineitem: DataFrame, flag_col: str = "l_returnflag",
                    flag_value: str = "R") -> DataFrame:
    """(user_id, orders, flagged_orders, chargeback_rate): an order counts as
    flagged if any of its lines carries the flag. Lines are reduced to one
    row per order on the map side before the shuffle."""
    flagged = lineitem.groupBy("l_orderkey").agg(
        F.max((F.col(flag_col) == flag_value).cast("int")).alias("_flag"))
    o = orders.select("o_orderkey", "o_custkey").join(
        flagged, orders.o_orderkey == flagged.l_orderkey, "left")
    return o.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("_flag") == 1).alias("flagged_orders"),
    ).withColumn("chargeback_rate", F.col("flagged_orders") / F.col("orders"))


def _account_dim(users: DataFrame, chargeback: DataFrame, users_bound: DataFrame | None,
                 chargeback_bound: DataFrame | None) -> DataFrame:
    """Users full-joined with their chargeback rate: at most one row per user
    of either side, so its row count is bounded by the two sides' bounds
    together (the chargeback table has at most one row per order's
    customer, so the orders table bounds it)."""
    dim = users.select("user_id", "signup_date").join(
        chargeback.select("user_id", "chargeback_rate"), "user_id", "full")
    return broadcast_if_small(dim, [users_bound if users_bound is not None else users,
                                    chargeback_bound if chargeback_bound is not None else chargeback])


def add_account(tx: DataFrame, users: DataFrame, chargeback: DataFrame,
                users_bound: DataFrame | None = None, chargeback_bound: DataFrame | None = None) -> DataFrame:
    """Add days_since_signup and chargeback_rate. Both per-user tables are
    joined once into one dimension, broadcast only when its size check
    passes (else a shuffle join on user_id, skew split by AQE)."""
    dim = _account_dim(users, chargeback, users_bound, chargeback_bound)
    return tx.join(dim, "user_id", "left").withColumn(
        "days_since_signup", F.datediff(F.to_date("transaction_timestamp"), F.col("signup_date"))
    ).withColumn("chargeback_rate", F.coalesce(F.col("chargeback_rate"), F.lit(0.0))).drop("signup_date")


def account(transactions: DataFrame, users: DataFrame, chargeback: DataFrame,
            users_bound: DataFrame | None = None, chargeback_bound: DataFrame | None = None) -> DataFrame:
    t = transactions.select("transaction_id", "user_id", "transaction_timestamp")
    return add_account(t, users, chargeback, users_bound, chargeback_bound).select(
        "transaction_id", "user_id", "days_since_signup", "chargeback_rate")


def fraud_features(events: DataFrame, transactions: DataFrame, users: DataFrame,
                   chargeback: DataFrame, users_bound: DataFrame | None = None,
                   chargeback_bound: DataFrame | None = None) -> DataFrame:
    """All features, one row per transaction. Trailing windows and running
    totals come from one sweep per user (one distributed prefix sum), then
    the per-user dimension is joined on the same rows (no join back on
    transaction_id)."""
    base = transactions.select("transaction_id", "user_id", "transaction_timestamp", "amount")
    out = behaviour(events, base, keep=["transaction_timestamp", "amount"], with_running=True)
    out = _velocity_columns(out)
    out = add_account(out, users, chargeback, users_bound, chargeback_bound)
    return out.select("transaction_id", "user_id", "transaction_timestamp", "amount",
                      "sessions_24h", "distinct_event_types_24h", "spent_24h", "transactions_last_hour",
                      "lifetime_value", "amount_deviation_from_avg", "days_since_signup", "chargeback_rate")


def decide(features: DataFrame, score_col: str = "fraud_score") -> DataFrame:
    """Decision band for a model score supplied by the caller."""
    return features.withColumn("decision", score_band(score_col))
