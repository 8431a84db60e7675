"""Registered gold-layer queries (sessions, joins, metrics) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import to_ntz
from strata.operators import metrics
from strata.operators.joins import orphans
from strata.operators.sessions import SESSION_KEYS, session_aggregate, session_min_max_count
from strata.plans import gold, silver
from strata.registry import register
from strata.sources import landing

# ------------------------------------------------------------ shared inputs


def silver_inputs(spark, sf_dir):
    """(events_clean, transactions_clean, users_dim, users row bound)."""
    events = silver.events_clean(landing.app_events(spark, sf_dir))
    txns = silver.transactions_clean(landing.app_transactions(spark, sf_dir))
    users = silver.users_dim(landing.app_users(spark, sf_dir))
    return events, txns, users, landing.table(spark, sf_dir, "customer")


# DuckDB: the same silver tables, written independently.
SQL_SILVER = """
ev AS (
  SELECT event_id, user_id, event_type, ts, value,
         CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id
  FROM events
  WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_id
          ORDER BY ts DESC NULLS LAST, session_id DESC, user_id DESC, event_type DESC, value DESC) = 1
),
tx AS (
  SELECT event_id AS transaction_id,
         CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         user_id, value AS amount, 'USD' AS currency, ts AS transaction_timestamp
  FROM events
  WHERE event_type = 'purchase' AND event_id IS NOT NULL AND user_id IS NOT NULL
    AND value IS NOT NULL AND value > 0
  QUALIFY row_number() OVER (PARTITION BY event_id
          ORDER BY ts DESC NULLS LAST, session_id DESC, user_id DESC, amount DESC, currency DESC) = 1
),
users AS (
  SELECT c.c_custkey AS user_id, CAST(fo.first_order AS DATE) AS signup_date,
         trim(c.c_mktsegment) AS device_type, trim(n.n_name) AS country
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) fo
         ON c.c_custkey = fo.o_custkey
  WHERE c.c_custkey IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY c.c_custkey
          ORDER BY signup_date DESC NULLS LAST, device_type DESC, country DESC) = 1
),
sess AS (
  SELECT session_id, user_id,
         min(ts) AS session_start_time, max(ts) AS session_end_time,
         count(event_id) AS total_events,
         string_agg(event_type, ',' ORDER BY ts, event_id) AS event_path,
         first(event_type ORDER BY ts, event_id) AS first_event_type,
         last(event_type ORDER BY ts, event_id) AS last_event_type
  FROM ev GROUP BY session_id, user_id
),
first_tx AS (
  SELECT * FROM tx
  QUALIFY row_number() OVER (PARTITION BY session_id, user_id
          ORDER BY transaction_timestamp, transaction_id) = 1
)"""

SQL_GOLD_SELECT = """
SELECT s.user_id, s.session_id, u.signup_date, u.device_type, u.country,
       s.session_start_time, s.session_end_time,
       CAST(epoch_us(s.session_end_time) // 1000000 - epoch_us(s.session_start_time) // 1000000 AS INTEGER)
         AS session_duration_seconds,
       CAST(s.session_start_time AS DATE) AS session_date,
       CAST(s.total_events AS INTEGER) AS total_events,
       s.event_path, s.first_event_type, s.last_event_type,
       t.transaction_id, CAST(t.amount AS DECIMAL(10,2)) AS transaction_amount,
       t.currency AS transaction_currency, t.transaction_timestamp,
       t.transaction_id IS NOT NULL AS has_transaction,
       CASE WHEN t.transaction_timestamp IS NOT NULL THEN
         CAST(epoch_us(t.transaction_timestamp) // 1000000 - epoch_us(s.session_start_time) // 1000000 AS INTEGER)
       END AS time_to_purchase_seconds,
       1 AS data_version, 'local_pipeline' AS source_system
"""

SQL_USA = f"""WITH {SQL_SILVER}
{SQL_GOLD_SELECT}
FROM sess s
LEFT JOIN first_tx t ON s.session_id = t.session_id AND s.user_id = t.user_id
LEFT JOIN users u ON s.user_id = u.user_id"""

# the gold table as a CTE named g
SQL_G = f"""WITH {SQL_SILVER}, g AS ({SQL_GOLD_SELECT}
FROM sess s
LEFT JOIN first_tx t ON s.session_id = t.session_id AND s.user_id = t.user_id
LEFT JOIN users u ON s.user_id = u.user_id)"""

SQL_FANOUT = f"""WITH {SQL_SILVER}
{SQL_GOLD_SELECT}
FROM sess s
LEFT JOIN tx t ON s.session_id = t.session_id AND s.user_id = t.user_id
LEFT JOIN users u ON s.user_id = u.user_id"""


@register("user_session_analysis", SQL_USA)
def q_user_session_analysis(spark, sf_dir):
    e, t, u, bound = silver_inputs(spark, sf_dir)
    return gold.comparable(gold.user_session_analysis(e, t, u, bound, stamp=False))


@register("gold_sessions_fanout", SQL_FANOUT)
def q_gold_fanout(spark, sf_dir):
    e, t, u, bound = silver_inputs(spark, sf_dir)
    return gold.comparable(gold.gold_fanout(e, t, u, bound, stamp=False))


@register("gold_metrics", f"""WITH {SQL_SILVER}, g AS ({SQL_GOLD_SELECT}
FROM sess s
LEFT JOIN first_tx t ON s.session_id = t.session_id AND s.user_id = t.user_id
LEFT JOIN users u ON s.user_id = u.user_id)
SELECT count(*) AS total_sessions,
       count(*) FILTER (WHERE has_transaction) AS sessions_with_purchase,
       coalesce(count(*) FILTER (WHERE has_transaction) * 100.0 / nullif(count(*), 0), 0.0)
         AS conversion_rate_pct
FROM g""")
def q_gold_metrics(spark, sf_dir):
    e, t, u, bound = silver_inputs(spark, sf_dir)
    return gold.gold_metrics(gold.user_session_analysis(e, t, u, bound, stamp=False))


@register("session_aggregate", f"""WITH {SQL_SILVER}
SELECT session_id, user_id, session_start_time, session_end_time, total_events, event_path,
       first_event_type, last_event_type,
       CAST(epoch_us(session_end_time) // 1000000 - epoch_us(session_start_time) // 1000000 AS INTEGER)
         AS session_duration_seconds,
       CAST(session_start_time AS DATE) AS session_date
FROM sess""")
def q_session_aggregate(spark, sf_dir):
    e, _, _, _ = silver_inputs(spark, sf_dir)
    s = session_aggregate(e)
    return s.select("session_id", "user_id", to_ntz("session_start_time").alias("session_start_time"),
                    to_ntz("session_end_time").alias("session_end_time"), "total_events",
                    F.array_join("event_types", ",").alias("event_path"),
                    "first_event_type", "last_event_type", "session_duration_seconds", "session_date")


@register("session_min_max_count", f"""WITH {SQL_SILVER}
SELECT session_id, user_id, session_start_time, session_end_time, total_events FROM sess""")
def q_session_min_max_count(spark, sf_dir):
    e, _, _, _ = silver_inputs(spark, sf_dir)
    s = session_min_max_count(e)
    return s.select("session_id", "user_id", to_ntz("session_start_time").alias("session_start_time"),
                    to_ntz("session_end_time").alias("session_end_time"), "total_events")


@register("session_event_path", f"""WITH {SQL_SILVER}
SELECT session_id, user_id, event_path FROM sess""")
def q_session_event_path(spark, sf_dir):
    e, _, _, _ = silver_inputs(spark, sf_dir)
    from strata.functions.ordered import ordered_path
    s = e.groupBy(*SESSION_KEYS).agg(
        ordered_path("event_type", "event_timestamp", "event_id").alias("p"))
    return s.select(*SESSION_KEYS, F.array_join("p", ",").alias("event_path"))


@register("session_first_last", f"""WITH {SQL_SILVER}
SELECT session_id, user_id, first_event_type, last_event_type FROM sess""")
def q_session_first_last(spark, sf_dir):
    e, _, _, _ = silver_inputs(spark, sf_dir)
    from strata.functions.ordered import first_by_time, last_by_time
    return e.groupBy(*SESSION_KEYS).agg(
        first_by_time("event_type", "event_timestamp", "event_id").alias("first_event_type"),
        last_by_time("event_type", "event_timestamp", "event_id").alias("last_event_type"))


@register("join_users_left", f"""WITH {SQL_SILVER}
SELECT s.session_id, s.user_id, u.signup_date, u.device_type, u.country, s.total_events
FROM sess s LEFT JOIN users u ON s.user_id = u.user_id""")
def q_join_users_left(spark, sf_dir):
    e, _, u, bound = silver_inputs(spark, sf_dir)
    from strata.operators.joins import broadcast_if_small
    s = session_min_max_count(e)
    users = broadcast_if_small(u.select("user_id", "signup_date", "device_type", "country"), bound)
    return s.join(users, "user_id", "left").select(
        "session_id", "user_id", "signup_date", "device_type", "country", "total_events")


@register("join_transactions_left", f"""WITH {SQL_SILVER}
SELECT s.session_id, s.user_id, s.total_events, t.transaction_id,
       CAST(t.amount AS DECIMAL(10,2)) AS transaction_amount
FROM sess s LEFT JOIN tx t ON s.session_id = t.session_id AND s.user_id = t.user_id""")
def q_join_transactions_left(spark, sf_dir):
    e, t, _, _ = silver_inputs(spark, sf_dir)
    from strata.functions.scalar import to_money
    from strata.operators.joins import left_join_fanout
    s = session_min_max_count(e)
    tx = t.select(*SESSION_KEYS, "transaction_id", to_money("amount").alias("transaction_amount"))
    return left_join_fanout(s, tx, SESSION_KEYS).select(
        "session_id", "user_id", "total_events", "transaction_id", "transaction_amount")


@register("orphan_check", f"""WITH {SQL_SILVER}
SELECT t.transaction_id, t.session_id, t.user_id
FROM tx t WHERE NOT EXISTS (SELECT 1 FROM sess s WHERE s.session_id = t.session_id AND s.user_id = t.user_id)""")
def q_orphan_check(spark, sf_dir):
    """Purchases whose session has no clean event (they vanish from gold)."""
    e, t, _, _ = silver_inputs(spark, sf_dir)
    return orphans(t, e, SESSION_KEYS).select("transaction_id", "session_id", "user_id")


@register("conversion_by_country", f"""WITH {SQL_SILVER}, g AS ({SQL_GOLD_SELECT}
FROM sess s
LEFT JOIN first_tx t ON s.session_id = t.session_id AND s.user_id = t.user_id
LEFT JOIN users u ON s.user_id = u.user_id)
SELECT country, strftime(session_date, '%Y-%m') AS month,
       count(*) AS sessions,
       count(*) FILTER (WHERE has_transaction) AS purchases,
       count(*) FILTER (WHERE has_transaction) * 100.0 / count(*) AS conversion_rate_pct
FROM g GROUP BY country, month""")
def q_conversion_by_country(spark, sf_dir):
    e, t, u, bound = silver_inputs(spark, sf_dir)
    g = gold.user_session_analysis(e, t, u, bound, stamp=False)
    return metrics.conversion_by(g, ["country"], month_col="session_date")


FUNNEL_STEPS = ["view", "click", "purchase"]


@register("funnel", f"""WITH {SQL_SILVER},
f0 AS (SELECT session_id, user_id, min(ts) AS t0 FROM ev WHERE event_type = 'view'
       GROUP BY session_id, user_id),
f1 AS (SELECT e.session_id, e.user_id, min(e.ts) AS t1
       FROM ev e JOIN f0 ON e.session_id = f0.session_id AND e.user_id = f0.user_id
       WHERE e.event_type = 'click' AND e.ts > f0.t0 GROUP BY e.session_id, e.user_id),
f2 AS (SELECT e.session_id, e.user_id, min(e.ts) AS t2
       FROM ev e JOIN f1 ON e.session_id = f1.session_id AND e.user_id = f1.user_id
       WHERE e.event_type = 'purchase' AND e.ts > f1.t1 GROUP BY e.session_id, e.user_id)
SELECT 1 AS step, 'view' AS event_type, (SELECT count(*) FROM f0) AS sessions
UNION ALL SELECT 2, 'click', (SELECT count(*) FROM f1)
UNION ALL SELECT 3, 'purchase', (SELECT count(*) FROM f2)""")
def q_funnel(spark, sf_dir):
    e, _, _, _ = silver_inputs(spark, sf_dir)
    return metrics.funnel(e, FUNNEL_STEPS, SESSION_KEYS, "event_type", "event_timestamp")


@register("funnel_from_paths", f"""WITH {SQL_SILVER},
f0 AS (SELECT session_id, user_id, min(ts) AS t0 FROM ev WHERE event_type = 'view'
       GROUP BY session_id, user_id),
f1 AS (SELECT e.session_id, e.user_id, min(e.ts) AS t1
       FROM ev e JOIN f0 ON e.session_id = f0.session_id AND e.user_id = f0.user_id
       WHERE e.event_type = 'click' AND e.ts > f0.t0 GROUP BY e.session_id, e.user_id),
f2 AS (SELECT e.session_id, e.user_id, min(e.ts) AS t2
       FROM ev e JOIN f1 ON e.session_id = f1.session_id AND e.user_id = f1.user_id
       WHERE e.event_type = 'purchase' AND e.ts > f1.t1 GROUP BY e.session_id, e.user_id)
SELECT 1 AS step, 'view' AS event_type, (SELECT count(*) FROM f0) AS sessions
UNION ALL SELECT 2, 'click', (SELECT count(*) FROM f1)
UNION ALL SELECT 3, 'purchase', (SELECT count(*) FROM f2)""")
def q_funnel_from_paths(spark, sf_dir):
    """The same funnel read from the gold table's stored ordered path
    (one pass over gold, no shuffle)."""
    e, t, u, bound = silver_inputs(spark, sf_dir)
    g = gold.user_session_analysis(e, t, u, bound, stamp=False)
    return metrics.funnel_from_paths(g, FUNNEL_STEPS, "event_types")
