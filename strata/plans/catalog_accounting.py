"""Registered queries of the stream that keeps its late rows, and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import to_ntz
from strata.plans.catalog_streaming import LATE_EVERY, LATE_HOURS_MIN, LATE_HOURS_SPAN
from strata.registry import register
from strata.session import new_path
from strata.sources import landing
from strata.streaming import accounting, jobs

# Fixed values.
ARRIVALS = 8
DELAY_HOURS = 6
ROWS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                     T.StructField("event_type", T.StringType()), T.StructField("event_timestamp", T.TimestampType())])

SQL_LATE = f"""
k AS (SELECT greatest({ARRIVALS}, (count(*) + {landing.ARRIVAL_ROWS - 1}) // {landing.ARRIVAL_ROWS}) AS k,
             coalesce(max(event_id), 0) + 1 AS ids FROM events),
e AS (
  SELECT event_id, user_id, event_type, event_id * k // ids AS arrival,
         CASE WHEN event_id % {LATE_EVERY} = 0
              THEN ts - to_hours({LATE_HOURS_MIN} + (event_id // {LATE_EVERY}) % {LATE_HOURS_SPAN})
              ELSE ts END AS ts
  FROM events, k
),
marks AS (
  SELECT arrival, max(newest) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    - INTERVAL {DELAY_HOURS} HOURS AS mark
  FROM (SELECT arrival, max(ts) AS newest FROM e GROUP BY arrival)
),
judged AS (
  SELECT e.*, mark, coalesce(CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) <= mark, FALSE) AS late,
         CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS closes
  FROM e JOIN marks USING (arrival)
)"""


def _split(spark, sf_dir) -> str:
    """Events in arrivals, every LATE_EVERY-th delayed by 2 to 48 hours, dealt
    by a mark 6 hours behind the newest event: late when the user's day is over."""
    shift = F.expr(f"make_dt_interval(0, {LATE_HOURS_MIN} + (event_id div {LATE_EVERY}) % {LATE_HOURS_SPAN}, 0, 0)")
    ts = F.when(F.col("event_id") % LATE_EVERY == 0, F.col("ts") - shift).otherwise(F.col("ts"))
    src = landing.land_event_arrivals(spark, sf_dir, new_path(spark, "arrivals"), ts, ARRIVALS)
    out = new_path(spark, "split")
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(src).select(*ROWS.fieldNames())
    q = accounting.split_late(stream, "event_timestamp", DELAY_HOURS * 3600, out, new_path(spark, "ck"), 86400)
    _finish(q)
    return out


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@register("stream_late_events", f"""WITH {SQL_LATE}
SELECT event_id, user_id, event_type, ts AS event_timestamp, mark,
       CAST(epoch_us(mark) - epoch_us(ts) AS DOUBLE) / 1000000.0 AS behind_seconds
FROM judged WHERE late""")
def q_stream_late_events(spark, sf_dir):
    """The side table of rows that a stateful day-session stream would drop."""
    late = accounting.rows_of(spark, _split(spark, sf_dir), "late", ROWS)
    return late.select("event_id", "user_id", "event_type", to_ntz("event_timestamp").alias("event_timestamp"),
                       to_ntz("mark").alias("mark"), "behind_seconds")


@register("stream_accounting", f"""WITH {SQL_LATE},
z AS (SELECT max(ts) - INTERVAL {DELAY_HOURS} HOURS AS last_mark FROM e),
c AS (
  SELECT count(*) AS read, count(*) FILTER (WHERE NOT late) AS on_time, count(*) FILTER (WHERE late) AS late,
         count(*) FILTER (WHERE ts IS NULL) AS untimed,
         count(*) FILTER (WHERE NOT late AND closes <= last_mark) AS emitted
  FROM judged, z
)
SELECT *, on_time - emitted AS open, CAST(0 AS BIGINT) AS dropped FROM c""")
def q_stream_accounting(spark, sf_dir):
    """Day sessions over the on-time rows: rows read = late + untimed + emitted
    + open, and the stateful operator itself drops none."""
    out = _split(spark, sf_dir)
    sink = new_path(spark, "sessions")
    sessions = jobs.session_stream(accounting.on_time_stream(spark, out, ROWS), delay=f"{DELAY_HOURS} hours")
    counter = accounting.DropCounter()
    spark.streams.addListener(counter)
    try:
        q = (sessions.writeStream.format("parquet").option("path", sink).option("checkpointLocation", new_path(spark, "ck"))
             .outputMode("append").trigger(availableNow=True).start())
        _finish(q)
        dropped = counter.dropped(q)
    finally:
        spark.streams.removeListener(counter)
    totals = accounting.account(spark, out, spark.read.schema(sessions.schema).parquet(sink), "total_events")
    return totals.withColumn("dropped", F.lit(dropped).cast("bigint"))
