"""Registered queries of merged profiles, drift between loads and open
payloads, and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import quality as dq
from strata.operators import sketches as sk
from strata.plans.catalog_quality import ALLOWED_EVENT_TYPES
from strata.registry import register
from strata.session import new_path
from strata.sources import landing, payloads

# Fixed values.
VALUE_CUTS = [2.0, 5.0, 10.0, 20.0, 50.0]
DISTINCT_ERROR = 0.05
COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _weekly_sketches(spark, sf_dir, cols):
    """Sketches of the events' loads (weeks), written once and read back."""
    path = new_path(spark, "sketches")
    week = F.to_date(F.date_trunc("week", "ts"))
    bins = {"value": VALUE_CUTS, "event_type": ALLOWED_EVENT_TYPES}
    sk.load_sketches(landing.table(spark, sf_dir, "events"), week, cols,
                     {c: b for c, b in bins.items() if c in cols}).write.parquet(path)
    return spark.read.parquet(path)


@register("profile_merged", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
       CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
       TRUE AS distinct_within FROM events""" for c in COLUMNS))
def q_profile_merged(spark, sf_dir):
    """The table's profile from the sketches of its weeks; distinct counts are
    within 5 % of the exact ones."""
    p = sk.profile(sk.merge_sketches(_weekly_sketches(spark, sf_dir, COLUMNS)))
    exact = dq.column_profile(landing.table(spark, sf_dir, "events"), COLUMNS, exact=True).select("column", "distinct_count")
    error = F.abs(F.col("distinct_estimate") - F.col("distinct_count"))
    return p.join(exact, "column").select(
        "column", "row_count", "null_count", "min_value", "max_value",
        (error <= F.col("distinct_count") * DISTINCT_ERROR).alias("distinct_within"))


_VOCABULARY = ", ".join(f"'{v}'" for v in ALLOWED_EVENT_TYPES)
_VALUE_BIN = " + ".join(f"CAST(value >= {c} AS INTEGER)" for c in VALUE_CUTS)
_NULL_BIN = len(VALUE_CUTS) + 1

SQL_DRIFT = f"""
l AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS load, value, event_type FROM events),
b AS (
  SELECT load, 'value' AS col, CASE WHEN value IS NULL THEN {_NULL_BIN} ELSE {_VALUE_BIN} END AS bin FROM l
  UNION ALL
  SELECT load, 'event_type', CASE WHEN event_type IS NULL THEN {_NULL_BIN}
    ELSE coalesce(nullif(list_position([{_VOCABULARY}], event_type), 0) - 1, {len(ALLOWED_EVENT_TYPES)}) END FROM l
),
loads AS (SELECT load, count(*) AS rows FROM l GROUP BY load),
cells AS (
  SELECT load, rows, col, bin, coalesce(n, 0) AS n
  FROM loads CROSS JOIN (SELECT unnest(['value', 'event_type']) AS col) CROSS JOIN (SELECT unnest(range({_NULL_BIN + 1})) AS bin)
  LEFT JOIN (SELECT load, col, bin, count(*) AS n FROM b GROUP BY ALL) USING (load, col, bin)
),
past AS (
  SELECT *, sum(n) OVER w AS m, sum(rows) OVER w AS earlier_rows FROM cells
  WINDOW w AS (PARTITION BY col, bin ORDER BY load ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
shares AS (
  SELECT *, (n + 0.5) / (rows + {(_NULL_BIN + 1) / 2}) AS p, (m + 0.5) / (earlier_rows + {(_NULL_BIN + 1) / 2}) AS q,
         sum(n) FILTER (WHERE bin < {_NULL_BIN}) OVER u AS nc, sum(m) FILTER (WHERE bin < {_NULL_BIN}) OVER u AS mc,
         sum(n) FILTER (WHERE bin < {_NULL_BIN}) OVER t AS np, sum(m) FILTER (WHERE bin < {_NULL_BIN}) OVER t AS mp
  FROM past WHERE m IS NOT NULL
  WINDOW u AS (PARTITION BY col, load ORDER BY bin), t AS (PARTITION BY col, load)
),
distances AS (
  SELECT load, col, any_value(rows) AS rows, any_value(earlier_rows) AS earlier_rows, sum((p - q) * ln(p / q)) AS psi,
         coalesce(max(abs(nc / nullif(np, 0) - mc / nullif(mp, 0))) FILTER (WHERE bin < {_NULL_BIN}), 0.0) AS ks
  FROM shares GROUP BY load, col
)"""


@register("load_drift", f"""WITH {SQL_DRIFT}
SELECT load, col AS column, rows, CAST(earlier_rows AS BIGINT) AS earlier_rows, round(psi, 6) AS psi, round(ks, 6) AS ks
FROM distances""")
def q_load_drift(spark, sf_dir):
    """Distance of each week's events from all earlier weeks, from stored bins."""
    d = sk.drift(_weekly_sketches(spark, sf_dir, ["value", "event_type"]))
    return d.withColumns({"psi": F.round("psi", 6), "ks": F.round("ks", 6)})


@register("drift_limits", f"""WITH {SQL_DRIFT},
limits AS (
  SELECT *, CASE WHEN count(*) OVER w >= 2 THEN greatest(avg(psi) OVER w + 4 * stddev_pop(psi) OVER w, 0.05) ELSE 0.05 END AS psi_limit,
         CASE WHEN count(*) OVER w >= 2 THEN greatest(avg(ks) OVER w + 4 * stddev_pop(ks) OVER w, 0.05) ELSE 0.05 END AS ks_limit
  FROM distances WINDOW w AS (PARTITION BY col ORDER BY load ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT load, col AS column, round(psi_limit, 6) AS psi_limit, round(ks_limit, 6) AS ks_limit,
       psi > psi_limit OR ks > ks_limit AS drifted FROM limits""")
def q_drift_limits(spark, sf_dir):
    """Limits learnt from earlier weeks, and the weeks that break them."""
    d = sk.drift(_weekly_sketches(spark, sf_dir, ["value", "event_type"]))
    j = sk.drift_limits(d, floor_psi=0.05, floor_ks=0.05, least_loads=2)
    return j.select("load", "column", F.round("psi_limit", 6).alias("psi_limit"), F.round("ks_limit", 6).alias("ks_limit"), "drifted")


# ------------------------------------------------------------ open payloads

# Keys of the rendered payloads that no schema declares.
KNOWN = {"price": "double"}
CORRUPT_EVERY = landing.CORRUPT_EVERY


def _open_events(spark, sf_dir):
    """Events with their payload text: price, the props' k, a coupon on every
    3rd event, an object on errors, a key of two types; some truncated."""
    e = landing.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    text = F.to_json(F.struct(
        F.col("value").alias("price"), k.alias("k"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("C"), (F.col("event_id") % 10).cast("string"))).alias("coupon"),
        F.when(F.col("event_type") == "error", F.struct((F.col("event_id") % 5).alias("code"))).alias("context"),
        F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).alias("score")))
    number = F.regexp_replace(text, r"\}$", F.concat(F.lit(',"score":'), (F.col("event_id") % 7).cast("string"), F.lit("}")))
    text = F.when(F.col("event_id") % 4 == 1, number).otherwise(text)
    text = F.when(F.col("event_id") % CORRUPT_EVERY == 0, F.substring(text, 1, F.length(text) - 1)).otherwise(text)
    path = new_path(spark, "open_events")
    payloads.parse_open(e.select("event_id", text.alias("details")), "details", KNOWN).drop("details").write.parquet(path)
    return spark.read.parquet(path)


@register("open_payloads", f"""SELECT event_id, event_id % {CORRUPT_EVERY} = 0 AS is_corrupt,
  CASE WHEN event_id % {CORRUPT_EVERY} <> 0 THEN value END AS price,
  CASE WHEN event_id % {CORRUPT_EVERY} <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  CASE WHEN event_id % {CORRUPT_EVERY} <> 0 AND event_id % 3 = 0 THEN 'C' || (event_id % 10) END AS coupon,
  CASE WHEN event_id % {CORRUPT_EVERY} <> 0 THEN concat_ws(',', CASE WHEN event_type = 'error' THEN 'context' END,
    CASE WHEN event_id % 3 = 0 THEN 'coupon' END, CASE WHEN json_extract(props, '$.k') IS NOT NULL THEN 'k' END,
    CASE WHEN event_id % 4 <= 1 THEN 'score' END) END AS unknown_keys
FROM events""")
def q_open_payloads(spark, sf_dir):
    """Payloads kept whole: undeclared keys are in the written table, named,
    and lifted to typed columns afterwards."""
    t = payloads.lift(payloads.lift(_open_events(spark, sf_dir), "k", "bigint"), "coupon", "string")
    return t.select("event_id", "is_corrupt", "price", "k", "coupon",
                    F.array_join(payloads.unknown_keys(t, KNOWN), ",").alias("unknown_keys"))


@register("payload_schema_drift", f"""WITH good AS (SELECT * FROM events WHERE event_id % {CORRUPT_EVERY} <> 0),
r AS (
  SELECT 'k' AS key, 'BIGINT' AS type, count(*) AS rows FROM good WHERE json_extract(props, '$.k') IS NOT NULL
  UNION ALL SELECT 'coupon', 'STRING', count(*) FROM good WHERE event_id % 3 = 0
  UNION ALL SELECT 'context', 'OBJECT', count(*) FROM good WHERE event_type = 'error'
  UNION ALL SELECT 'score', 'STRING', count(*) FROM good WHERE event_id % 4 = 0
  UNION ALL SELECT 'score', 'BIGINT', count(*) FROM good WHERE event_id % 4 = 1
)
SELECT key, type, rows, key <> 'score' AS settled FROM r WHERE rows > 0""")
def q_payload_schema_drift(spark, sf_dir):
    """Undeclared keys by type, and whether one type holds throughout."""
    report = payloads.key_report(_open_events(spark, sf_dir), KNOWN)
    settled = payloads.settled_keys(report).select("key", F.lit(True).alias("settled"))
    return report.join(settled, "key", "left").select("key", "type", "rows", F.coalesce("settled", F.lit(False)).alias("settled"))
