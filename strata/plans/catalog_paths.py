"""Registered queries of chunked session paths and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import to_ntz
from strata.operators import paths
from strata.plans.catalog_gold import FUNNEL_STEPS, SQL_SILVER, silver_inputs
from strata.registry import register
from strata.session import new_path

# Fixed value: events of a chunk, small enough that the given tables'
# sessions span several chunks.
CHUNK_EVENTS = 3

SQL_POSITIONS = f"""WITH {SQL_SILVER},
path AS (
  SELECT session_id, user_id, event_type, ts,
         row_number() OVER (PARTITION BY session_id, user_id ORDER BY ts, event_id) AS position
  FROM ev WHERE ts IS NOT NULL
)"""
SQL_STEPS = f"""{SQL_POSITIONS},
p1 AS (SELECT session_id, user_id, min(position) AS position FROM path
       WHERE event_type = '{FUNNEL_STEPS[0]}' GROUP BY ALL),
p2 AS (SELECT path.session_id, path.user_id, min(path.position) AS position FROM path JOIN p1
       ON path.session_id = p1.session_id AND path.user_id = p1.user_id AND path.position > p1.position
       WHERE event_type = '{FUNNEL_STEPS[1]}' GROUP BY ALL),
p3 AS (SELECT path.session_id, path.user_id, min(path.position) AS position FROM path JOIN p2
       ON path.session_id = p2.session_id AND path.user_id = p2.user_id AND path.position > p2.position
       WHERE event_type = '{FUNNEL_STEPS[2]}' GROUP BY ALL)"""


def _chunks(spark, sf_dir):
    events, _, _, _ = silver_inputs(spark, sf_dir)
    path = new_path(spark, "session_paths")
    paths.path_chunks(events, chunk=CHUNK_EVENTS).write.parquet(path)
    return spark.read.parquet(path)


@register("session_path_chunks", f"""{SQL_POSITIONS}
SELECT session_id, user_id, position, event_type, ts AS event_time FROM path""")
def q_session_path_chunks(spark, sf_dir):
    """Every event at its position in its session's path, from chunks that
    no session holds in one row."""
    rows = paths.path_positions(_chunks(spark, sf_dir))
    return rows.withColumn("event_time", to_ntz("event_time"))


@register("funnel_by_chunks", f"""{SQL_STEPS}
SELECT 1 AS step, '{FUNNEL_STEPS[0]}' AS event_type, (SELECT count(*) FROM p1) AS sessions
UNION ALL SELECT 2, '{FUNNEL_STEPS[1]}', (SELECT count(*) FROM p2)
UNION ALL SELECT 3, '{FUNNEL_STEPS[2]}', (SELECT count(*) FROM p3)""")
def q_funnel_by_chunks(spark, sf_dir):
    """The funnel from transition functions composed over a session's chunks."""
    return paths.funnel_by_chunks(_chunks(spark, sf_dir), FUNNEL_STEPS)


@register("funnel_step_times", f"""{SQL_STEPS},
steps AS (SELECT *, 1 AS step FROM p1 UNION ALL SELECT *, 2 FROM p2 UNION ALL SELECT *, 3 FROM p3)
SELECT session_id, user_id, step, event_type, position, ts AS reached_at
FROM steps JOIN path USING (session_id, user_id, position)""")
def q_funnel_step_times(spark, sf_dir):
    """When, and at which event, each session reached each step."""
    out = paths.write_step_times(_chunks(spark, sf_dir), FUNNEL_STEPS, new_path(spark, "step_times"))
    return out.withColumn("reached_at", to_ntz(F.col("reached_at")))
