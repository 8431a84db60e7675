"""Registered fraud-feature queries and their oracles.

The oracle computes trailing windows with correlated subqueries and running
totals with one per-user window: an independent formulation of what the
bucketed Spark operators compute.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import features
from strata.plans.catalog_gold import SQL_SILVER, silver_inputs
from strata.registry import register
from strata.sources import landing


# Purchases that arrive without a time, and without a user.
NO_TIME_EVERY, NO_USER_EVERY = 29, 31


def _inputs(spark, sf_dir):
    """(events, transactions, users, chargeback, row bounds): the row bounds
    of users and of the chargeback table (one row per ordering customer,
    so at most the orders table's rows) for the broadcast check."""
    e, t, u, bound = silver_inputs(spark, sf_dir)
    at = F.col("transaction_id")
    t = t.withColumns({
        "transaction_timestamp": F.when(at % NO_TIME_EVERY != 0, F.col("transaction_timestamp")),
        "user_id": F.when(at % NO_USER_EVERY != 0, F.col("user_id"))})
    orders = landing.table(spark, sf_dir, "orders")
    cb = features.chargeback_rate(orders, landing.table(spark, sf_dir, "lineitem"))
    return e, t, u, cb, (bound, orders)


SQL_FEATURES = f"""WITH {SQL_SILVER},
txc AS (
  SELECT transaction_id, CASE WHEN transaction_id % {NO_USER_EVERY} <> 0 THEN user_id END AS user_id,
         CASE WHEN transaction_id % {NO_TIME_EVERY} <> 0 THEN transaction_timestamp END AS ts, amount,
         CAST(CAST(amount AS DECIMAL(18, 2)) * 100 AS BIGINT) AS cents
  FROM tx
),
beh AS (
  SELECT t.transaction_id,
    (SELECT count(DISTINCT e.session_id) FROM ev e
      WHERE e.user_id IS NOT DISTINCT FROM t.user_id AND e.ts >= t.ts - INTERVAL 24 HOURS AND e.ts <= t.ts) AS sessions_24h,
    (SELECT count(DISTINCT e.event_type) FROM ev e
      WHERE e.user_id IS NOT DISTINCT FROM t.user_id AND e.ts >= t.ts - INTERVAL 24 HOURS AND e.ts <= t.ts)
      AS distinct_event_types_24h,
    CAST((SELECT coalesce(sum(x.cents), 0) FROM txc x
      WHERE x.user_id IS NOT DISTINCT FROM t.user_id AND x.ts >= t.ts - INTERVAL 24 HOURS AND x.ts <= t.ts) AS DOUBLE) / 100.0
      AS spent_24h,
    (SELECT count(*) FROM txc x
      WHERE x.user_id IS NOT DISTINCT FROM t.user_id AND x.ts >= t.ts - INTERVAL 1 HOUR AND x.ts <= t.ts)
      AS transactions_last_hour
  FROM txc t
),
run AS (
  SELECT transaction_id, cents,
         sum(cents) OVER w AS cum_cents, count(*) OVER w AS n
  FROM txc WHERE ts IS NOT NULL
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, transaction_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
vel AS (
  SELECT transaction_id,
         CAST(cum_cents AS DOUBLE) / 100.0 AS lifetime_value,
         CASE WHEN n - 1 > 0 THEN
           CAST(cents * (n - 1) - (cum_cents - cents) AS DOUBLE) / CAST((n - 1) * 100 AS DOUBLE)
         END AS amount_deviation_from_avg
  FROM run
),
flag AS (
  SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS f FROM lineitem GROUP BY l_orderkey
),
cb AS (
  SELECT o.o_custkey AS user_id, count(*) AS orders, count(*) FILTER (WHERE flag.f = 1) AS flagged_orders,
         CAST(count(*) FILTER (WHERE flag.f = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS chargeback_rate
  FROM orders o LEFT JOIN flag ON o.o_orderkey = flag.l_orderkey
  GROUP BY o.o_custkey
),
acc AS (
  SELECT t.transaction_id,
         date_diff('day', u.signup_date, CAST(t.ts AS DATE)) AS days_since_signup,
         coalesce(cb.chargeback_rate, 0.0) AS chargeback_rate
  FROM txc t LEFT JOIN users u ON t.user_id = u.user_id LEFT JOIN cb ON t.user_id = cb.user_id
),
ff AS (
  SELECT t.transaction_id, t.user_id, t.ts AS transaction_timestamp, t.amount,
         beh.sessions_24h, beh.distinct_event_types_24h, beh.spent_24h, beh.transactions_last_hour,
         vel.lifetime_value, vel.amount_deviation_from_avg,
         acc.days_since_signup, acc.chargeback_rate
  FROM txc t
  JOIN beh ON t.transaction_id = beh.transaction_id
  LEFT JOIN vel ON t.transaction_id = vel.transaction_id
  JOIN acc ON t.transaction_id = acc.transaction_id
)"""


def _ntz(df):
    return df.withColumn("transaction_timestamp", F.col("transaction_timestamp").cast("timestamp_ntz"))


@register("fraud_features", f"{SQL_FEATURES}\nSELECT * FROM ff")
def q_fraud_features(spark, sf_dir):
    e, t, u, cb, (bound, cb_bound) = _inputs(spark, sf_dir)
    return _ntz(features.fraud_features(e, t, u, cb, bound, cb_bound))


def _single(name, cols, part):
    sql = f"{SQL_FEATURES}\nSELECT transaction_id, {', '.join(cols)} FROM ff"

    def q(spark, sf_dir):
        e, t, u, cb, (bound, cb_bound) = _inputs(spark, sf_dir)
        if part == "behaviour":
            df = features.behaviour(e, t, only=cols)
        elif part == "velocity":
            df = features.velocity(t)
        else:
            df = features.account(t, u, cb, bound, cb_bound)
        return df.select("transaction_id", *cols)
    q.__name__ = f"q_{name}"
    register(name, sql)(q)


_single("sessions_24h", ["sessions_24h"], "behaviour")
_single("spent_24h", ["spent_24h"], "behaviour")
_single("distinct_values_24h", ["distinct_event_types_24h"], "behaviour")
_single("transactions_last_hour", ["transactions_last_hour"], "behaviour")
_single("amount_deviation_from_avg", ["amount_deviation_from_avg"], "velocity")
_single("lifetime_value", ["lifetime_value"], "velocity")
_single("days_since_signup", ["days_since_signup"], "account")


def _of_users(name, column):
    """Distinct values of a user attribute over the user's events of the last
    24 hours (the given events carry none of their own)."""
    def q(spark, sf_dir):
        e, t, u, _, _ = _inputs(spark, sf_dir)
        e = e.join(u.select("user_id", column), "user_id", "left").withColumn("event_type", F.col(column))
        df = features.behaviour(e, t, only=["distinct_event_types_24h"])
        return df.select("transaction_id", F.col("distinct_event_types_24h").alias(name))
    q.__name__ = f"q_{name}"
    register(name, f"""{SQL_FEATURES}
SELECT t.transaction_id, (SELECT count(DISTINCT u.{column}) FROM ev e JOIN users u ON e.user_id = u.user_id
  WHERE e.user_id IS NOT DISTINCT FROM t.user_id AND e.ts >= t.ts - INTERVAL 24 HOURS AND e.ts <= t.ts) AS {name}
FROM txc t""")(q)


_of_users("distinct_devices_24h", "device_type")
_of_users("distinct_countries_24h", "country")


@register("chargeback_rate", f"{SQL_FEATURES}\nSELECT user_id, orders, flagged_orders, chargeback_rate FROM cb")
def q_chargeback_rate(spark, sf_dir):
    return features.chargeback_rate(landing.table(spark, sf_dir, "orders"),
                                    landing.table(spark, sf_dir, "lineitem"))


@register("score_band", f"""{SQL_FEATURES}
SELECT transaction_id, chargeback_rate AS fraud_score,
       CASE WHEN chargeback_rate > 0.8 THEN 'BLOCK' WHEN chargeback_rate >= 0.5 THEN 'REVIEW'
            WHEN chargeback_rate IS NOT NULL THEN 'APPROVE' END AS decision
FROM ff""")
def q_score_band(spark, sf_dir):
    """Decision bands, with the user's chargeback rate standing in for the
    model score."""
    e, t, u, cb, (bound, cb_bound) = _inputs(spark, sf_dir)
    f = features.account(t, u, cb, bound, cb_bound).select(
        "transaction_id", F.col("chargeback_rate").alias("fraud_score"))
    return features.decide(f)
