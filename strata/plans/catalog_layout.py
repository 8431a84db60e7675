"""Registered queries of clustered and bucketed tables and their oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.functions.scalar import to_money, to_ntz
from strata.operators.sessions import SESSION_KEYS, session_min_max_count
from strata.plans import gold
from strata.plans.catalog_gold import SQL_SILVER, SQL_USA, silver_inputs
from strata.plans.catalog_tables import SPLIT
from strata.registry import register
from strata.session import new_path
from strata.tables import buckets, layout

# Small files and row groups, so that the given tables fill many.
FILE_ROWS, GROUP_ROWS = 5_000, 1_000
BUCKETS = 8
EVENT = ["event_id", "session_id", "user_id", "event_type", "event_timestamp"]
SQL_EVENT = "event_id, session_id, user_id, event_type, ts AS event_timestamp"


def _clustered(spark, sf_dir):
    events, _, _, _ = silver_inputs(spark, sf_dir)
    path = new_path(spark, "clustered")
    layout.write_clustered(events.select(*EVENT), path, "user_id", "event_timestamp", ["session_id"], FILE_ROWS, GROUP_ROWS)
    return spark.read.parquet(path)


def _out(events):
    return events.select(*EVENT[:-1], to_ntz("event_timestamp").alias("event_timestamp"))


@register("write_clustered", f"WITH {SQL_SILVER} SELECT {SQL_EVENT} FROM ev")
def q_write_clustered(spark, sf_dir):
    """The events table ordered by a space-filling curve over user and time."""
    return _out(_clustered(spark, sf_dir))


def _busiest(events, key):
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).first()[key]


@register("clustered_user_lookup", f"""WITH {SQL_SILVER}
SELECT {SQL_EVENT} FROM ev
WHERE user_id = (SELECT user_id FROM ev GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)""")
def q_clustered_user_lookup(spark, sf_dir):
    """All events of the user that has the most: most row groups are skipped."""
    t = _clustered(spark, sf_dir)
    return _out(t.filter(F.col("user_id") == F.lit(_busiest(t, "user_id"))))


@register("clustered_session_lookup", f"""WITH {SQL_SILVER}
SELECT {SQL_EVENT} FROM ev
WHERE session_id = (SELECT session_id FROM ev GROUP BY session_id ORDER BY count(*) DESC, session_id LIMIT 1)""")
def q_clustered_session_lookup(spark, sf_dir):
    """All events of the session that has the most."""
    t = _clustered(spark, sf_dir)
    return _out(t.filter(F.col("session_id") == F.lit(_busiest(t, "session_id"))))


@register("bucketed_gold_merge", SQL_USA)
def q_bucketed_gold_merge(spark, sf_dir):
    """Gold of the events up to SPLIT as a bucketed table, then a load with
    the sessions that later events, or purchases, touch; gold isn't moved."""
    e, t, u, bound = silver_inputs(spark, sf_dir)
    early = (F.col("event_timestamp") < F.lit(SPLIT).cast("timestamp")) | F.col("event_timestamp").isNull()
    name, path = f"gold_{uuid.uuid4().hex}", new_path(spark, "gold")
    buckets.write_bucketed(gold.user_session_analysis(e.filter(early), t.limit(0), u, bound, stamp=False), name, path, SESSION_KEYS, BUCKETS)
    touched = e.filter(~early).select(*SESSION_KEYS).unionByName(t.select(*SESSION_KEYS)).distinct()
    load = gold.user_session_analysis(e.join(touched, SESSION_KEYS, "left_semi"), t, u, bound, stamp=False)
    return gold.comparable(buckets.merge_bucketed(spark, name, path, load, SESSION_KEYS, BUCKETS))


@register("bucketed_transactions_join", f"""WITH {SQL_SILVER}
SELECT s.session_id, s.user_id, s.total_events, t.transaction_id,
       CAST(t.amount AS DECIMAL(10,2)) AS transaction_amount
FROM sess s LEFT JOIN tx t ON s.session_id = t.session_id AND s.user_id = t.user_id""")
def q_bucketed_transactions_join(spark, sf_dir):
    """Sessions and purchases bucketed alike: joined without an exchange."""
    e, t, _, _ = silver_inputs(spark, sf_dir)
    purchases = t.select(*SESSION_KEYS, "transaction_id", to_money("amount").alias("transaction_amount"))
    sides = []
    for label, df in (("sessions", session_min_max_count(e)), ("purchases", purchases)):
        buckets.check_balance(df, SESSION_KEYS, BUCKETS)
        sides.append(buckets.write_bucketed(df, f"{label}_{uuid.uuid4().hex}", new_path(spark, label), SESSION_KEYS, BUCKETS))
    joined = sides[0].join(sides[1].hint("shuffle_merge"), SESSION_KEYS, "left")
    return joined.select(*SESSION_KEYS, "total_events", "transaction_id", "transaction_amount")
