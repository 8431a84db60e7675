"""Registered table-write and time-bounded-read queries and their oracles.

Writes go to fresh folders under the session's shared folder
(``spark.checkpoint.dir``); each query then reads the written table back,
so the comparison covers the write.

Loads: the given events split by event time at SPLIT into two loads; the
second load re-delivers the days from OVERLAP_FROM with corrected values
(value + 0.5), so an upsert has matched and unmatched keys. Every
REPEAT_EVERY-th row that the upsert leaves alone, and every REPEAT_EVERY-th
that it inserts, is there twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.scalar import to_ntz
from strata.plans import gold, silver
from strata.plans.catalog_gold import SQL_GOLD_SELECT, SQL_SILVER, SQL_USA, silver_inputs
from strata.plans.catalog_silver import SQL_LINES, valid_events
from strata.registry import register
from strata.session import new_path
from strata.sources import landing, readers
from strata.tables import loads, writes

# Load boundaries and read windows (event time, UTC).
SPLIT = "2024-01-20 00:00:00"
OVERLAP_FROM = "2024-01-15 00:00:00"
CORRECTION = 0.5
REPEAT_EVERY = 40
HIGH_WATER_MARK = "2024-01-20 00:00:00"
LOOKBACK_AS_OF = "2024-01-30"
LOOKBACK_DAYS = 2
REPLAY_FROM, REPLAY_TO = "2024-01-10 00:00:00", "2024-01-12 00:00:00"
GOLD_UPSERT_FROM = "2024-01-19 00:00:00"

EVENT_COLS = ["event_id", "session_id", "user_id", "event_type", "event_timestamp", "value"]


def _events(spark, sf_dir):
    return silver.events_clean(landing.app_events(spark, sf_dir)).select(*EVENT_COLS)


def _loads(spark, sf_dir):
    e = _events(spark, sf_dir)
    ts, cut, overlap = F.col("event_timestamp"), F.lit(SPLIT).cast("timestamp"), F.lit(OVERLAP_FROM).cast("timestamp")
    repeated = F.col("event_id") % REPEAT_EVERY == 0
    load1 = e.filter((ts < cut) | ts.isNull())
    load1 = load1.unionByName(e.filter(((ts < overlap) | ts.isNull()) & repeated))
    load2 = e.filter(ts >= overlap)
    load2 = load2.unionByName(e.filter((ts >= cut) & repeated)).withColumn("value", F.col("value") + F.lit(CORRECTION))
    return load1, load2


def _out(df):
    return df.select("event_id", to_ntz("event_timestamp").alias("event_timestamp"), "value")


SQL_LOADS = f"""WITH {SQL_SILVER},
l1 AS (
  SELECT * FROM ev WHERE ts < TIMESTAMP '{SPLIT}' OR ts IS NULL
  UNION ALL SELECT * FROM ev WHERE (ts < TIMESTAMP '{OVERLAP_FROM}' OR ts IS NULL) AND event_id % {REPEAT_EVERY} = 0
),
l2 AS (
  SELECT event_id, session_id, user_id, event_type, ts, value + {CORRECTION} AS value
  FROM (SELECT * FROM ev WHERE ts >= TIMESTAMP '{OVERLAP_FROM}'
        UNION ALL SELECT * FROM ev WHERE ts >= TIMESTAMP '{SPLIT}' AND event_id % {REPEAT_EVERY} = 0)
),
merged AS (
  SELECT event_id, ts, value FROM l1 WHERE event_id NOT IN (SELECT event_id FROM l2)
  UNION ALL SELECT event_id, ts, value FROM l2
)"""


@register("write_replace", f"""WITH {SQL_SILVER}
SELECT event_id, session_id, user_id, event_type, ts AS event_timestamp, value FROM ev""")
def q_write_replace(spark, sf_dir):
    path = new_path(spark, "events_clean")
    writes.write_replace(_events(spark, sf_dir), path)
    back = readers.read_table(spark, path)
    return back.withColumn("event_timestamp", to_ntz("event_timestamp"))


@register("write_partitioned", SQL_USA)
def q_write_partitioned(spark, sf_dir):
    e, t, u, bound = silver_inputs(spark, sf_dir)
    path = new_path(spark, "gold")
    writes.write_partitioned(gold.user_session_analysis(e, t, u, bound), path, "session_date")
    return gold.comparable(spark.read.parquet(path))


@register("merge_upsert", f"{SQL_LOADS}\nSELECT event_id, ts AS event_timestamp, value FROM merged")
def q_merge_upsert(spark, sf_dir):
    load1, load2 = _loads(spark, sf_dir)
    return _out(writes.merge_upsert(load1, load2, ["event_id"]))


@register("merge_join", f"""{SQL_LOADS}
SELECT (SELECT count(*) FROM l2 WHERE event_id IN (SELECT event_id FROM l1)) AS matched,
       (SELECT count(*) FROM l2 WHERE event_id NOT IN (SELECT event_id FROM l1)) AS inserted,
       (SELECT count(*) FROM l1 WHERE event_id NOT IN (SELECT event_id FROM l2)) AS untouched""")
def q_merge_join(spark, sf_dir):
    """Matched / not-matched split of a MERGE, one full outer join."""
    load1, load2 = _loads(spark, sf_dir)
    j = (load1.select("event_id", F.lit(True).alias("_t"))
         .join(load2.select("event_id", F.lit(True).alias("_u")), "event_id", "full"))
    return j.agg(F.count_if(F.col("_t") & F.col("_u")).alias("matched"),
                 F.count_if(F.col("_t").isNull()).alias("inserted"),
                 F.count_if(F.col("_u").isNull()).alias("untouched"))


@register("merge_cardinality_check", f"""WITH {SQL_LINES}
SELECT event_id, count(*) AS source_rows FROM clean
WHERE event_id IN (SELECT event_id FROM dedup)
GROUP BY event_id HAVING count(*) > 1""")
def q_merge_cardinality_check(spark, sf_dir):
    """Keys of the silver table that a raw (undeduplicated) load would
    update more than once."""
    raw = silver.events_clean(valid_events(spark, sf_dir), extra_cols=())
    updates = valid_events(spark, sf_dir)
    from strata.operators.cleaning import require_not_null
    updates = require_not_null(updates, silver.EVENT_KEYS)
    return writes.merge_cardinality_violations(raw, updates, ["event_id"])


def _history(spark, sf_dir):
    load1, load2 = _loads(spark, sf_dir)
    path = new_path(spark, "events_loads")
    loads.append_load(load1, path, 1)
    loads.append_load(load2, path, 2)
    return path


@register("dedup_by_merge", f"{SQL_LOADS}\nSELECT event_id, ts AS event_timestamp, value FROM merged")
def q_dedup_by_merge(spark, sf_dir):
    """Two loads merged into a table by key: the newest load wins."""
    load1, load2 = _loads(spark, sf_dir)
    path = new_path(spark, "events_merged")
    for load in (load1, load2):
        dated = load.withColumn("event_date", F.to_date("event_timestamp"))
        writes.upsert_partitions(spark, path, dated, ["event_id"], "event_date")
    return _out(readers.read_table(spark, path))


@register("snapshot_history", f"""{SQL_LOADS}
SELECT 1 AS version, 'create' AS operation, (SELECT count(*) FROM l1) AS row_count
UNION ALL SELECT 2, 'upsert', (SELECT count(*) FROM merged)""")
def q_snapshot_history(spark, sf_dir):
    """Rows of the table as of every load."""
    h = loads.load_history(spark, _history(spark, sf_dir), ["event_id"])
    return h.select(F.col(loads.LOAD).alias("version"),
                    F.when(F.col(loads.LOAD) == 1, "create").otherwise("upsert").alias("operation"), "row_count")


@register("time_travel_read", f"{SQL_LOADS}\nSELECT event_id, ts AS event_timestamp, value FROM l1")
def q_time_travel_read(spark, sf_dir):
    """The table as of its first load."""
    return _out(loads.as_of(spark, _history(spark, sf_dir), ["event_id"], load=1))


@register("rollback_to", f"{SQL_LOADS}\nSELECT event_id, ts AS event_timestamp, value FROM l1")
def q_rollback_to(spark, sf_dir):
    """Back to the first load: its state becomes the table."""
    first = loads.as_of(spark, _history(spark, sf_dir), ["event_id"], load=1)
    back = new_path(spark, "events_back")
    writes.write_replace(first, back)
    return _out(readers.read_table(spark, back))


@register("evolve_schema", f"""SELECT event_id,
       CASE WHEN ts >= TIMESTAMP '{SPLIT}' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
FROM events""")
def q_evolve_schema(spark, sf_dir):
    """A column added by a later load, old files untouched (read with
    schema merging)."""
    raw = landing.app_events(spark, sf_dir)
    cut = F.lit(SPLIT).cast("timestamp")
    path = new_path(spark, "evolving")
    raw.filter((F.col("event_timestamp") < cut) | F.col("event_timestamp").isNull()).select("event_id").write.mode("append").parquet(path)
    (raw.filter(F.col("event_timestamp") >= cut)
     .select("event_id", F.col("event_details.k").alias("k")).write.mode("append").parquet(path))
    return spark.read.option("mergeSchema", True).parquet(path).select("event_id", "k")


@register("quarantine_write", f"""WITH {SQL_LINES}
SELECT regexp_extract(line, '"event_id":"([0-9]+)"', 1) AS event_id,
       regexp_extract(line, '"session_id":"([^"]*)"', 1) AS session_id, count(*) AS lines
FROM lines WHERE NOT json_valid(line) GROUP BY 1, 2""")
def q_quarantine_write(spark, sf_dir):
    """Corrupt raw lines written to a quarantine folder, read back; what can
    still be read of them."""
    _, bad = silver.events_from_json(landing.event_json_lines(spark, sf_dir))
    path = new_path(spark, "quarantine")
    writes.quarantine_write(bad, path)
    back = spark.read.text(path)
    return back.groupBy(F.regexp_extract("value", '"event_id":"([0-9]+)"', 1).alias("event_id"),
                        F.regexp_extract("value", '"session_id":"([^"]*)"', 1).alias("session_id")).agg(
        F.count(F.lit(1)).alias("lines"))


@register("upsert_partitions", SQL_USA)
def q_upsert_partitions(spark, sf_dir):
    """Gold published from the events before GOLD_UPSERT_FROM, then the
    sessions from that day on recomputed (a re-run with late data) and
    upserted partition by partition."""
    e, t, u, bound = silver_inputs(spark, sf_dir)
    cut = F.lit(GOLD_UPSERT_FROM).cast("timestamp")
    path = new_path(spark, "gold_live")
    keys = ["session_id", "user_id"]
    timed = F.col("event_timestamp")
    first = gold.user_session_analysis(e.filter((timed < cut) | timed.isNull()), t, u, bound)
    writes.upsert_partitions(spark, path, first, keys, "session_date")
    later = gold.user_session_analysis(
        e.filter(F.col("event_timestamp") >= cut - F.expr("INTERVAL 1 DAY")), t, u, bound)
    writes.upsert_partitions(spark, path, later, keys, "session_date")
    return gold.comparable(spark.read.parquet(path))


# ----------------------------------------------------------- bounded reads


def _raw_events(spark, sf_dir):
    return landing.table(spark, sf_dir, "events")


@register("incremental_read", f"""SELECT event_id, ts, user_id, event_type FROM events
WHERE ts > TIMESTAMP '{HIGH_WATER_MARK}'""")
def q_incremental_read(spark, sf_dir):
    return readers.incremental_read(_raw_events(spark, sf_dir), "ts", HIGH_WATER_MARK).select(
        "event_id", "ts", "user_id", "event_type")


@register("high_water_mark", f"""SELECT max(ts) AS high_water_mark FROM events
WHERE ts > TIMESTAMP '{HIGH_WATER_MARK}'""")
def q_high_water_mark(spark, sf_dir):
    inc = readers.incremental_read(_raw_events(spark, sf_dir), "ts", HIGH_WATER_MARK)
    return readers.high_water_mark(inc, "ts")


_LB_END = dt.date.fromisoformat(LOOKBACK_AS_OF) + dt.timedelta(days=1)
_LB_START = dt.date.fromisoformat(LOOKBACK_AS_OF) - dt.timedelta(days=LOOKBACK_DAYS - 1)


@register("lookback_read", f"""SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '{_LB_START} 00:00:00' AND ts < TIMESTAMP '{_LB_END} 00:00:00'""")
def q_lookback_read(spark, sf_dir):
    return readers.lookback_read(_raw_events(spark, sf_dir), "ts", LOOKBACK_AS_OF, LOOKBACK_DAYS).select(
        "event_id", "ts", "user_id", "event_type")


@register("replay_from", f"""SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '{REPLAY_FROM}' AND ts < TIMESTAMP '{REPLAY_TO}'""")
def q_replay_from(spark, sf_dir):
    return readers.replay_from(_raw_events(spark, sf_dir), "ts", REPLAY_FROM, REPLAY_TO).select(
        "event_id", "ts", "user_id", "event_type")


@register("read_table", f"""WITH {SQL_SILVER}, g AS ({SQL_GOLD_SELECT}
FROM sess s
LEFT JOIN first_tx t ON s.session_id = t.session_id AND s.user_id = t.user_id
LEFT JOIN users u ON s.user_id = u.user_id)
SELECT session_date, count(*) AS sessions FROM g GROUP BY session_date""")
def q_read_table(spark, sf_dir):
    """A written partitioned table read back by path, grouped by its
    partition column."""
    e, t, u, bound = silver_inputs(spark, sf_dir)
    path = new_path(spark, "gold_read")
    writes.write_partitioned(gold.user_session_analysis(e, t, u, bound), path, "session_date")
    assert readers.table_exists(spark, path)
    return readers.read_table(spark, path).groupBy("session_date").agg(F.count(F.lit(1)).alias("sessions"))


# ------------------------------------------------------------ end to end

def _medallion_sql():
    from strata.plans.catalog_silver import SQL_TX, SQL_USERS
    return f"""WITH {SQL_LINES}, {SQL_TX}, {SQL_USERS},
udim AS (
  SELECT * FROM ud QUALIFY row_number() OVER (PARTITION BY user_id
         ORDER BY signup_date DESC NULLS LAST, device_type DESC, country DESC) = 1
),
sessm AS (
  SELECT session_id, user_id,
         min(event_timestamp) AS session_start_time, max(event_timestamp) AS session_end_time,
         count(event_id) AS total_events,
         string_agg(event_type, ',' ORDER BY event_timestamp, event_id) AS event_path,
         first(event_type ORDER BY event_timestamp, event_id) AS first_event_type,
         last(event_type ORDER BY event_timestamp, event_id) AS last_event_type
  FROM dedup GROUP BY session_id, user_id
),
ftx AS (
  SELECT * FROM txclean QUALIFY row_number() OVER (PARTITION BY session_id, user_id
         ORDER BY transaction_timestamp, transaction_id) = 1
)
{SQL_GOLD_SELECT}
FROM sessm s
LEFT JOIN ftx t ON s.session_id = t.session_id AND s.user_id = t.user_id
LEFT JOIN udim u ON s.user_id = u.user_id"""


@register("medallion_run", _medallion_sql())
def q_medallion_run(spark, sf_dir):
    """Raw JSON / CSV text -> silver tables (written) -> quality gate ->
    gold table (partition-scoped upsert), read back."""
    from strata.plans.catalog_quality import gold_rules
    from strata.plans.medallion import run_medallion
    res = run_medallion(spark, landing.event_json_lines(spark, sf_dir),
                        landing.transaction_csv_lines(spark, sf_dir), landing.user_csv_lines(spark, sf_dir),
                        new_path(spark, "lake"), gold_rules=gold_rules)
    return gold.comparable(spark.read.parquet(res.paths["user_session_analysis"]))


@register("medallion_incremental", _medallion_sql())
def q_medallion_incremental(spark, sf_dir):
    """The same lines in two loads, dealt by a checksum of the line, so that
    re-deliveries, purchases and users arrive apart from their sessions:
    silver is merged, gold recomputed for touched sessions; equals one load."""
    from strata.plans.catalog_quality import gold_rules
    from strata.plans.medallion import run_medallion
    base = new_path(spark, "lake")
    for k in (0, 1):
        part = [lines.filter(F.crc32(F.col("value").cast("binary")) % 2 == k) for lines in (
            landing.event_json_lines(spark, sf_dir), landing.transaction_csv_lines(spark, sf_dir), landing.user_csv_lines(spark, sf_dir))]
        res = run_medallion(spark, *part, base, load=k)
    return gold.comparable(spark.read.parquet(res.paths["user_session_analysis"]))


@register("incremental_loads", f"""WITH m AS (SELECT max(ts) AS mark FROM events WHERE ts <= TIMESTAMP '{HIGH_WATER_MARK}'),
twins AS (SELECT -event_id AS event_id, ts FROM events, m WHERE ts = mark)
SELECT event_id, ts, CASE WHEN ts <= (SELECT mark FROM m) THEN 1 ELSE 3 END AS load FROM events
UNION ALL SELECT event_id, ts, 3 FROM twins""")
def q_incremental_loads(spark, sf_dir):
    """Three loads by a stored high-water mark: the events up to a time, then
    nothing new, then everything, with rows that tie with the mark and arrive
    late. Every row is taken exactly once."""
    from strata.sources import marks
    events = _raw_events(spark, sf_dir).select("event_id", "ts")
    early = events.filter(F.col("ts") <= F.lit(HIGH_WATER_MARK).cast("timestamp_ntz"))
    at = early.agg(F.max("ts")).first()[0]
    twins = early.filter(F.col("ts") == F.lit(at).cast("timestamp_ntz")).select((-F.col("event_id")).alias("event_id"), "ts")
    mark, out = new_path(spark, "mark"), new_path(spark, "increments")
    for load, source in ((1, early), (2, early), (3, events.unionByName(twins))):
        loads.append_load(marks.increment(spark, source, mark, "event_id", "ts"), out, load)
        back = spark.read.schema("event_id bigint, ts timestamp_ntz, load_id int").parquet(out).filter(F.col(loads.LOAD) == load)
        marks.advance(spark, back.select("event_id", "ts"), mark, "event_id", "ts")
    return spark.read.parquet(out).select("event_id", "ts", F.col(loads.LOAD).alias("load"))


@register("read_table_by_name", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def q_read_table_by_name(spark, sf_dir):
    """A table of the session's catalog read by its name."""
    _raw_events(spark, sf_dir).createOrReplaceTempView("strata_raw_events")
    return readers.read_table(spark, "strata_raw_events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@register("table_exists", """SELECT * FROM (VALUES ('events', true, (SELECT count(*) FROM events)),
  ('no_such_table', false, NULL), ('strata_raw_users', true, (SELECT count(*) FROM customer)),
  ('strata_no_such_table', false, NULL)) AS t(table_name, found, row_count)""")
def q_table_exists(spark, sf_dir):
    """Tables looked up by path and by name; those found are counted."""
    landing.app_users(spark, sf_dir).createOrReplaceTempView("strata_raw_users")
    names = {"events": f"{sf_dir}/events.parquet", "no_such_table": f"{sf_dir}/no_such_table.parquet",
             "strata_raw_users": "strata_raw_users", "strata_no_such_table": "strata_no_such_table"}
    out = None
    for name, where in names.items():
        found = readers.table_exists(spark, where)
        rows = (readers.read_table(spark, where).agg(F.count(F.lit(1)).alias("row_count")) if found
                else spark.range(1).select(F.lit(None).cast("bigint").alias("row_count")))
        rows = rows.select(F.lit(name).alias("table_name"), F.lit(found).alias("found"), "row_count")
        out = rows if out is None else out.unionByName(rows)
    return out
