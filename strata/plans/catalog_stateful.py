"""Registered queries of the stateful stream operators and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import to_ntz
from strata.plans.catalog_streaming import DEDUP_DELAY, LANDED_FILES, SQL_LANDED, _landed, _run
from strata.registry import register
from strata.session import new_path
from strata.sources import landing
from strata.sources.readers import parse_json_lines
from strata.sources.schemas import CORRUPT_COL, LANDED_EVENT
from strata.streaming import jobs, stateful

# Files a micro-batch, session gap, and which events come one
# file late (all within the watermark).
FILES_A_BATCH = 3
GAP_HOURS = 6
LATE_FILE_EVERY = 7
SESSION_WATERMARK = "30 days"


@register("stream_dedup_newest", f"""WITH {SQL_LANDED}
SELECT event_id, session_id, user_id, event_type, event_timestamp, value FROM dedup""")
def q_stream_dedup_newest(spark, sf_dir):
    """The newest copy of every event, corrections emitted again: whole rows
    equal the batch dedup."""
    stream = jobs.json_line_stream(spark, _landed(spark, sf_dir), max_files_per_trigger=FILES_A_BATCH)
    parsed = parse_json_lines(stream, "value", LANDED_EVENT, CORRUPT_COL)
    clean = jobs.clean_events(parsed.filter(F.col(CORRUPT_COL).isNull()))
    out = new_path(spark, "newest")
    newest = stateful.dedup_newest(clean, "event_id", "event_timestamp", DEDUP_DELAY, 600_000)
    with stateful.state_store(spark):
        _run(stateful.run_to_parquet(newest, out, new_path(spark, "ck")))
    rows = stateful.current_rows(spark.read.parquet(out).drop("batch"), ["event_id"])
    return rows.select("event_id", "session_id", "user_id", "event_type", to_ntz("event_timestamp").alias("event_timestamp"), "value")


@register("stream_session_update", f"""WITH m AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL {GAP_HOURS} HOUR
            THEN 0 ELSE 1 END AS starts FROM events
),
n AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT user_id, min(ts) AS session_start_time, max(ts) AS session_end_time, count(event_id) AS total_events,
       first(event_type ORDER BY ts, event_id) AS first_event_type, last(event_type ORDER BY ts, event_id) AS last_event_type
FROM n GROUP BY user_id, k""")
def q_stream_session_update(spark, sf_dir):
    """Gap sessions emitted while open, over files in which every
    LATE_FILE_EVERY-th event comes one file late: the last emission of each
    session equals the batch sessions, open ones included."""
    e = landing.table(spark, sf_dir, "events")
    src, out = new_path(spark, "arrivals"), new_path(spark, "sessions")
    bounds = e.agg(F.min("event_id").alias("a"), F.max("event_id").alias("z"), F.count(F.lit(1)).alias("n")).first()
    width = (bounds["z"] - bounds["a"]) // LANDED_FILES + 1
    number = ((F.col("event_id") - bounds["a"]) / width).cast("int") + (F.col("event_id") % LATE_FILE_EVERY == 0).cast("int")
    rows = e.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("event_timestamp"), number.alias("file"))
    parts = landing.land_in_order(rows.filter(F.col("file").isNotNull()), src, "file", LANDED_FILES + 1, bounds["n"])
    stream = spark.readStream.schema(rows.drop("file").schema).option("maxFilesPerTrigger", FILES_A_BATCH * parts).parquet(src)
    sessions = stateful.open_sessions(stream, GAP_HOURS * 3600, SESSION_WATERMARK)
    with stateful.state_store(spark):
        _run(stateful.run_to_parquet(sessions, out, new_path(spark, "ck")))
    got = stateful.current_rows(spark.read.parquet(out).drop("batch"), ["user_id", "session_start_time"])
    return got.select("user_id", to_ntz("session_start_time").alias("session_start_time"), to_ntz("session_end_time").alias("session_end_time"),
                      "total_events", "first_event_type", "last_event_type")
