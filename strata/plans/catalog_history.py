"""Registered queries over the history of the gold table: three loads and a
return, each state compared with a full recomputation.

Load 1: gold of the events before HALF_DAY. Load 2: the sessions that have an
event since then, recomputed (sessions of that day continue). Load 3: the
sessions of some users are removed. Load 4: back to load 2.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import to_ntz
from strata.operators.sessions import SESSION_KEYS
from strata.plans import gold
from strata.plans.catalog_gold import SQL_GOLD_SELECT, SQL_SILVER, silver_inputs
from strata.registry import register
from strata.session import new_path
from strata.tables import loads

# When the first load ends, and whose sessions the third removes.
HALF_DAY = "2024-01-20 12:00:00"
REMOVED_EVERY, REMOVED_REST = 11, 3

_JOINS = """
LEFT JOIN first_tx t ON s.session_id = t.session_id AND s.user_id = t.user_id
LEFT JOIN users u ON s.user_id = u.user_id"""

SQL_STATES = f"""WITH {SQL_SILVER},
early AS (
  SELECT session_id, user_id,
         min(ts) AS session_start_time, max(ts) AS session_end_time, count(event_id) AS total_events,
         string_agg(event_type, ',' ORDER BY ts, event_id) AS event_path,
         first(event_type ORDER BY ts, event_id) AS first_event_type,
         last(event_type ORDER BY ts, event_id) AS last_event_type
  FROM ev WHERE ts < TIMESTAMP '{HALF_DAY}' GROUP BY session_id, user_id
),
state1 AS ({SQL_GOLD_SELECT} FROM early s {_JOINS}),
state2 AS ({SQL_GOLD_SELECT} FROM sess s {_JOINS}),
state3 AS (SELECT * FROM state2 WHERE user_id % {REMOVED_EVERY} <> {REMOVED_REST})"""


def gold_loads(spark, sf_dir) -> str:
    """The history's folder after four loads."""
    e, t, u, bound = silver_inputs(spark, sf_dir)
    cut = F.lit(HALF_DAY).cast("timestamp")
    path = new_path(spark, "gold_loads")
    early = e.filter(F.col("event_timestamp") < cut)
    loads.append_load(gold.user_session_analysis(early, t, u, bound, stamp=False), path, 1)
    continued = e.filter(F.col("event_timestamp") >= cut).select(*SESSION_KEYS).distinct()
    loads.append_load(gold.user_session_analysis(e.join(continued, SESSION_KEYS, "left_semi"), t, u, bound, stamp=False), path, 2)
    gone = loads.as_of(spark, path, SESSION_KEYS).filter(F.col("user_id") % REMOVED_EVERY == REMOVED_REST)
    loads.append_load(gone.limit(0), path, 3, removed=gone, keys=SESSION_KEYS)
    loads.go_back(spark, path, SESSION_KEYS, to=2, load=4)
    return path


@register("gold_time_travel", f"""{SQL_STATES}
SELECT 1 AS load, * FROM state1 UNION ALL SELECT 2, * FROM state2 UNION ALL SELECT 3, * FROM state3""")
def q_gold_time_travel(spark, sf_dir):
    """Gold as of each of three loads, the last of which removes sessions."""
    path = gold_loads(spark, sf_dir)
    states = [gold.comparable(loads.as_of(spark, path, SESSION_KEYS, k)).select(F.lit(k).alias("load"), "*") for k in (1, 2, 3)]
    return states[0].unionByName(states[1]).unionByName(states[2])


@register("gold_rollback", f"{SQL_STATES} SELECT * FROM state2")
def q_gold_rollback(spark, sf_dir):
    """Gold after going back from the third load to the second."""
    return gold.comparable(loads.as_of(spark, gold_loads(spark, sf_dir), SESSION_KEYS))


@register("gold_history", f"""{SQL_STATES}
SELECT 1 AS load, (SELECT count(*) FROM state1) AS row_count UNION ALL SELECT 2, (SELECT count(*) FROM state2)
UNION ALL SELECT 3, (SELECT count(*) FROM state3) UNION ALL SELECT 4, (SELECT count(*) FROM state2)""")
def q_gold_history(spark, sf_dir):
    """Rows of gold as of every load."""
    h = loads.load_history(spark, gold_loads(spark, sf_dir), SESSION_KEYS)
    return h.select(F.col(loads.LOAD).alias("load"), "row_count")


@register("gold_validity", f"""{SQL_STATES},
firsts AS (
  SELECT a.session_id, a.user_id, a.session_end_time, a.total_events,
         a.session_id IN (SELECT session_id FROM ev WHERE ts >= TIMESTAMP '{HALF_DAY}') AS replaced FROM state1 a
),
spans AS (
  SELECT session_id, user_id, session_end_time, total_events, 1 AS valid_from,
         CASE WHEN replaced THEN 2 WHEN user_id % {REMOVED_EVERY} = {REMOVED_REST} THEN 3 END AS valid_to FROM firsts
  UNION ALL
  SELECT session_id, user_id, session_end_time, total_events, 2,
         CASE WHEN user_id % {REMOVED_EVERY} = {REMOVED_REST} THEN 3 END FROM state2
  WHERE session_id IN (SELECT session_id FROM ev WHERE ts >= TIMESTAMP '{HALF_DAY}')
  UNION ALL
  SELECT session_id, user_id, session_end_time, total_events, 4, NULL FROM state2 WHERE user_id % {REMOVED_EVERY} = {REMOVED_REST}
)
SELECT * FROM spans""")
def q_gold_validity(spark, sf_dir):
    """Every version of every session with the loads it is valid between."""
    rows = loads.intervals(spark, gold_loads(spark, sf_dir), SESSION_KEYS)
    return rows.select("session_id", "user_id", to_ntz("session_end_time").alias("session_end_time"), "total_events", "valid_from", "valid_to")
