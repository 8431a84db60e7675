"""Registered streaming queries and their oracles.

Each query lands the event JSON lines (with the fixed faults of
``sources.landing``) as files, or streams the given events parquet, runs
the Structured Streaming job to completion (``availableNow``), and reads
its sink back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import to_ntz
from strata.plans import gold
from strata.plans.catalog_gold import SQL_GOLD_SELECT, SQL_SILVER, silver_inputs
from strata.registry import register
from strata.session import new_path
from strata.sources import landing
from strata.streaming import jobs
from strata.streaming.late import late_event_report

# Fixed values.
LANDED_FILES = 6                 # arrival files (contiguous event-id ranges)
DEDUP_DELAY = "10 minutes"
SESSION_DELAY = "2 days"
LATE_EVERY = 20                  # every 20th event arrives late ...
LATE_HOURS_MIN, LATE_HOURS_SPAN = 2, 47   # ... by 2 to 48 hours
LATE_DELAY_SECONDS = 24 * 3600


def _landed(spark, sf_dir):
    path = new_path(spark, "landing")
    return landing.land_event_files(spark, sf_dir, path, files=LANDED_FILES)


def _run(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


SQL_LANDED = """
raw AS (
  SELECT event_id, user_id, event_type, ts, value FROM events
  UNION ALL
  SELECT event_id, user_id, event_type, ts + INTERVAL 1 SECOND, value + 1.0
  FROM events WHERE event_id % 50 = 0
),
rendered AS (
  SELECT event_id, CAST(json_object(
      'event_id', event_id,
      'session_id', CASE WHEN event_id % 89 <> 0
                         THEN CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) END,
      'user_id', user_id,
      'event_type', event_type,
      'event_timestamp', strftime(ts, '%Y-%m-%d %H:%M:%S.%f'),
      'event_details', json_object('price', value)) AS VARCHAR) AS j
  FROM raw
),
lines AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN substr(j, 1, length(j) - 1) ELSE j END AS line FROM rendered
),
parsed AS (
  SELECT NOT json_valid(line) AS is_corrupt,
         CASE WHEN json_valid(line) THEN CAST(json_extract(line, '$.event_id') AS BIGINT) END AS event_id,
         CASE WHEN json_valid(line) THEN json_extract_string(line, '$.session_id') END AS session_id,
         CASE WHEN json_valid(line) THEN CAST(json_extract(line, '$.user_id') AS BIGINT) END AS user_id,
         CASE WHEN json_valid(line) THEN json_extract_string(line, '$.event_type') END AS event_type,
         CASE WHEN json_valid(line) THEN
           CAST(json_extract_string(line, '$.event_timestamp') AS TIMESTAMP) END AS event_timestamp,
         CASE WHEN json_valid(line) THEN
           CAST(json_extract(line, '$.event_details.price') AS DOUBLE) END AS value
  FROM lines
),
clean AS (
  SELECT * FROM parsed
  WHERE NOT is_corrupt AND event_id IS NOT NULL AND user_id IS NOT NULL
    AND session_id IS NOT NULL AND event_type IS NOT NULL
),
dedup AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp DESC NULLS LAST,
          session_id DESC, user_id DESC, event_type DESC, value DESC) = 1
)"""


def _ingest(spark, sf_dir):
    src = _landed(spark, sf_dir)
    sink, quarantine, ck = new_path(spark, "ingest"), new_path(spark, "quarantine"), new_path(spark, "ck")
    _run(jobs.ingest(jobs.json_line_stream(spark, src, max_files_per_trigger=2), sink, quarantine, ck))
    return sink, quarantine


@register("stream_ingest", f"""WITH {SQL_LANDED}
SELECT event_id, session_id, user_id, event_type, event_timestamp, value,
       CAST(event_timestamp AS DATE) AS event_date FROM clean""")
def q_stream_ingest(spark, sf_dir):
    sink, _ = _ingest(spark, sf_dir)
    out = spark.read.parquet(sink)
    return out.select("event_id", "session_id", "user_id", "event_type",
                      to_ntz("event_timestamp").alias("event_timestamp"), "value", "event_date")


@register("stream_to_parquet_by_date", f"""WITH {SQL_LANDED}
SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS events FROM clean GROUP BY 1""")
def q_stream_to_parquet_by_date(spark, sf_dir):
    sink, _ = _ingest(spark, sf_dir)
    return spark.read.parquet(sink).groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


@register("stream_corrupt_split", f"""WITH {SQL_LANDED}
SELECT (SELECT count(*) FROM parsed WHERE is_corrupt) AS corrupt_count,
       (SELECT count(*) FROM clean) AS clean_count""")
def q_stream_corrupt_split(spark, sf_dir):
    sink, quarantine = _ingest(spark, sf_dir)
    bad = spark.read.text(quarantine).select(F.lit(1).alias("corrupt_count"), F.lit(0).alias("clean_count"))
    good = spark.read.parquet(sink).select(F.lit(0).alias("corrupt_count"), F.lit(1).alias("clean_count"))
    return bad.unionByName(good).agg(F.sum("corrupt_count").cast("bigint").alias("corrupt_count"),
                                     F.sum("clean_count").cast("bigint").alias("clean_count"))


@register("stream_dedup", f"WITH {SQL_LANDED}\nSELECT DISTINCT event_id FROM clean")
def q_stream_dedup(spark, sf_dir):
    """Re-deliveries dropped on the stream (which copy survives is the
    first seen, so only the ids are compared)."""
    src = _landed(spark, sf_dir)
    from strata.sources.readers import parse_json_lines
    from strata.sources.schemas import CORRUPT_COL, LANDED_EVENT
    stream = jobs.json_line_stream(spark, src, max_files_per_trigger=1)
    parsed = parse_json_lines(stream, "value", LANDED_EVENT, CORRUPT_COL)
    clean = jobs.clean_events(parsed.filter(F.col(CORRUPT_COL).isNull()))
    out, ck = new_path(spark, "dedup"), new_path(spark, "ck")
    q = (jobs.dedup_stream(clean, "event_id", "event_timestamp", DEDUP_DELAY)
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(out).select("event_id")


@register("stream_session_agg", f"""WITH s AS (
  SELECT CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id, user_id,
         min(ts) AS session_start_time, max(ts) AS session_end_time, count(event_id) AS total_events,
         first(event_type ORDER BY ts, event_id) AS first_event_type,
         last(event_type ORDER BY ts, event_id) AS last_event_type,
         CAST(ts AS DATE) + INTERVAL 1 DAY AS window_end
  FROM events GROUP BY user_id, CAST(ts AS DATE)
)
SELECT session_id, user_id, session_start_time, session_end_time, total_events,
       first_event_type, last_event_type
FROM s WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL {SESSION_DELAY}""")
def q_stream_session_agg(spark, sf_dir):
    """Day sessions emitted in append mode once the 2-day watermark has
    passed their end; sessions still open at the end of the input stay in
    the state store (not emitted), as in any append-mode stream."""
    folder = sf_dir.rstrip("/")
    ev = jobs.parquet_stream(spark, folder, "events.parquet").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("event_timestamp"))
    out, ck = new_path(spark, "sessions"), new_path(spark, "ck")
    q = (jobs.session_stream(ev, delay=SESSION_DELAY)
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(out).select(
        "session_id", "user_id", to_ntz("session_start_time").alias("session_start_time"),
        to_ntz("session_end_time").alias("session_end_time"), "total_events",
        "first_event_type", "last_event_type")


SESSION_GAP = "6 hours"


@register("stream_session_window", f"""WITH m AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL {SESSION_GAP}
            THEN 0 ELSE 1 END AS starts FROM events
),
n AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM m),
s AS (
  SELECT user_id, min(ts) AS session_start_time, max(ts) AS session_end_time, count(event_id) AS total_events,
         first(event_type ORDER BY ts, event_id) AS first_event_type,
         last(event_type ORDER BY ts, event_id) AS last_event_type,
         max(ts) + INTERVAL {SESSION_GAP} AS window_end
  FROM n GROUP BY user_id, k
)
SELECT user_id, session_start_time, session_end_time, window_end, total_events, first_event_type, last_event_type
FROM s WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL {SESSION_DELAY}""")
def q_stream_session_window(spark, sf_dir):
    """Sessions by inactivity gap (``session_window``), emitted in append mode
    once the watermark has passed their end."""
    ev = jobs.parquet_stream(spark, sf_dir.rstrip("/"), "events.parquet").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("event_timestamp"))
    out, ck = new_path(spark, "gap_sessions"), new_path(spark, "ck")
    _run(jobs.session_stream(ev, delay=SESSION_DELAY, gap=SESSION_GAP)
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    return spark.read.parquet(out).select(
        "user_id", to_ntz("session_start_time").alias("session_start_time"),
        to_ntz("session_end_time").alias("session_end_time"), to_ntz("window_end").alias("window_end"),
        "total_events", "first_event_type", "last_event_type")


@register("stream_upsert_gold", f"""WITH {SQL_LANDED}, {SQL_SILVER},
sessj AS (
  SELECT session_id, user_id,
         min(event_timestamp) AS session_start_time, max(event_timestamp) AS session_end_time,
         count(event_id) AS total_events,
         string_agg(event_type, ',' ORDER BY event_timestamp, event_id) AS event_path,
         first(event_type ORDER BY event_timestamp, event_id) AS first_event_type,
         last(event_type ORDER BY event_timestamp, event_id) AS last_event_type
  FROM dedup GROUP BY session_id, user_id
)
{SQL_GOLD_SELECT}
FROM sessj s
LEFT JOIN first_tx t ON s.session_id = t.session_id AND s.user_id = t.user_id
LEFT JOIN users u ON s.user_id = u.user_id""")
def q_stream_upsert_gold(spark, sf_dir):
    """Gold kept current by a stream of six arrival batches: sessions that
    continue in a later batch, re-deliveries and corrections update rows
    already published. There are six batches whatever the size (an arrival is
    as many files as its lines ask for): each is merged into the dates that it
    touches, so that more batches would write these dates more often."""
    src = _landed(spark, sf_dir)
    silver_path, gold_path, ck = new_path(spark, "silver"), new_path(spark, "gold"), new_path(spark, "ck")
    arrival = -(-landing.landed_files(spark, src) // LANDED_FILES)
    _run(jobs.gold_upsert(jobs.json_line_stream(spark, src, max_files_per_trigger=arrival),
                          silver_path, gold_path, ck,
                          lambda: silver_inputs(spark, sf_dir)[1], lambda: silver_inputs(spark, sf_dir)[2]))
    return gold.comparable(spark.read.parquet(gold_path))


_LATE_SHIFT = f"make_dt_interval(0, {LATE_HOURS_MIN} + (event_id div {LATE_EVERY}) % {LATE_HOURS_SPAN}, 0, 0)"


@register("late_event_report", f"""WITH e AS (
  SELECT event_id, user_id,
         CASE WHEN event_id % {LATE_EVERY} = 0
              THEN ts - to_hours({LATE_HOURS_MIN} + (event_id // {LATE_EVERY}) % {LATE_HOURS_SPAN})
              ELSE ts END AS ts
  FROM events
),
r AS (
  SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest_before
  FROM e
)
SELECT user_id, event_id, ts, newest_before,
       CAST(epoch_us(newest_before) - epoch_us(ts) AS DOUBLE) / 1000000.0 AS lateness_seconds,
       epoch_us(newest_before) - epoch_us(ts) > {LATE_DELAY_SECONDS * 1_000_000} AS behind_watermark
FROM r WHERE newest_before > ts""")
def q_late_event_report(spark, sf_dir):
    """Every LATE_EVERY-th event (arrival order = event id) delayed by 2 to
    48 hours; report what arrives behind a newer event of the same user."""
    e = landing.table(spark, sf_dir, "events")
    shifted = e.withColumn("ts", F.when(F.col("event_id") % LATE_EVERY == 0, F.col("ts") - F.expr(_LATE_SHIFT))
                           .otherwise(F.col("ts")))
    return late_event_report(shifted.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id",
                             LATE_DELAY_SECONDS)
