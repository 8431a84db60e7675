"""Registered bronze -> silver queries (raw readers, corrupt split, cleaning,
dedup, counts) and their oracles.

The raw inputs are JSON / CSV text rendered from the given tables with the
fixed fault rules of ``sources.landing`` (retries, missing session ids,
truncated lines), so every cleaning step has work to do on every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import to_ntz
from strata.operators.cleaning import require_not_null
from strata.operators.quality import corrupt_threshold
from strata.plans import silver
from strata.registry import register
from strata.sources import landing
from strata.sources.readers import parse_csv_lines
from strata.sources.schemas import CORRUPT_COL, RAW_TRANSACTION, RAW_USER

# Fixed value: alarm when more than 1% of raw lines are corrupt.
CORRUPT_ALARM_RATIO = 0.01


def parsed_events(spark, sf_dir):
    """All raw JSON lines parsed, corrupt ones included."""
    from strata.sources.readers import parse_json_lines
    return parse_json_lines(landing.event_json_lines(spark, sf_dir))


def valid_events(spark, sf_dir):
    return silver.events_from_json(landing.event_json_lines(spark, sf_dir))[0]


def _event_out(df):
    return df.select("event_id", "session_id", "user_id", "event_type",
                     to_ntz(F.col("event_timestamp").cast("timestamp")).alias("event_timestamp"),
                     F.col("event_details.price").alias("price"))


# DuckDB: render the same JSON lines independently, then parse them.
SQL_LINES = """
raw AS (
  SELECT event_id, user_id, event_type, ts, value FROM events
  UNION ALL
  SELECT event_id, user_id, event_type, ts + INTERVAL 1 SECOND, value + 1.0
  FROM events WHERE event_id % 50 = 0
),
rendered AS (
  SELECT event_id, CAST(json_object(
      'event_id', CAST(event_id AS VARCHAR),
      'session_id', CASE WHEN event_id % 89 <> 0
                         THEN CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) END,
      'user_id', CAST(user_id AS VARCHAR),
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
         CASE WHEN json_valid(line) THEN json_extract_string(line, '$.event_id') END AS event_id,
         CASE WHEN json_valid(line) THEN json_extract_string(line, '$.session_id') END AS session_id,
         CASE WHEN json_valid(line) THEN json_extract_string(line, '$.user_id') END AS user_id,
         CASE WHEN json_valid(line) THEN json_extract_string(line, '$.event_type') END AS event_type,
         CASE WHEN json_valid(line) THEN
           CAST(json_extract_string(line, '$.event_timestamp') AS TIMESTAMP) END AS event_timestamp,
         CASE WHEN json_valid(line) THEN
           CAST(json_extract(line, '$.event_details.price') AS DOUBLE) END AS price
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
          session_id DESC, user_id DESC, event_type DESC, price DESC) = 1
)"""


@register("read_events_json", f"""WITH {SQL_LINES}
SELECT event_id, session_id, user_id, event_type, event_timestamp, price, is_corrupt FROM parsed""")
def q_read_events_json(spark, sf_dir):
    p = parsed_events(spark, sf_dir)
    return p.select("event_id", "session_id", "user_id", "event_type",
                    to_ntz(F.try_to_timestamp("event_timestamp")).alias("event_timestamp"),
                    F.col("event_details.price").alias("price"),
                    F.col(CORRUPT_COL).isNotNull().alias("is_corrupt"))


@register("scan_json_files", f"""WITH {SQL_LINES}
SELECT is_corrupt, event_type, count(*) AS lines, sum(price) IS NOT NULL AS priced FROM parsed GROUP BY ALL""")
def q_scan_json_files(spark, sf_dir):
    """The raw JSON lines written as text files and read by the file reader."""
    from strata.session import new_path
    from strata.sources.readers import read_events_json
    path = new_path(spark, "json_files")
    landing.event_json_lines(spark, sf_dir).write.text(path)
    p = read_events_json(spark, path)
    return p.groupBy(F.col(CORRUPT_COL).isNotNull().alias("is_corrupt"), "event_type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("event_details.price").isNotNull().alias("priced"))


BAD_AMOUNT_EVERY = 23      # fixed value: purchases written with an amount that is no number


@register("scan_csv_files", f"""SELECT event_id AS transaction_id, user_id,
  CASE WHEN event_id % {BAD_AMOUNT_EVERY} <> 0 THEN CAST(value AS DECIMAL(12, 2)) END AS amount,
  event_id % {BAD_AMOUNT_EVERY} = 0 AS is_corrupt
FROM events WHERE event_type = 'purchase'""")
def q_scan_csv_files(spark, sf_dir):
    """Purchases written as CSV files with a header line and read by the file
    reader; a bad amount keeps its line as corrupt text."""
    from pyspark.sql import types as T

    from strata.session import new_path
    from strata.sources.readers import read_csv
    path = new_path(spark, "csv_files")
    t = landing.app_transactions(spark, sf_dir)
    amount = F.when(F.col("transaction_id") % BAD_AMOUNT_EVERY == 0, "n/a").otherwise(F.format_string("%.2f", "amount"))
    t.select("transaction_id", "user_id", amount.alias("amount")).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("transaction_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("amount", T.DecimalType(12, 2))])
    back = read_csv(spark, path, schema, header=True, corrupt_col=CORRUPT_COL)
    return back.select("transaction_id", "user_id", "amount", F.col(CORRUPT_COL).isNotNull().alias("is_corrupt"))


@register("corrupt_split", f"""WITH {SQL_LINES}
SELECT count(*) AS total_count,
       count(*) FILTER (WHERE is_corrupt) AS corrupt_count,
       count(*) FILTER (WHERE NOT is_corrupt) AS valid_count
FROM parsed""")
def q_corrupt_split(spark, sf_dir):
    p = parsed_events(spark, sf_dir)
    bad = F.col(CORRUPT_COL).isNotNull()
    return p.agg(F.count(F.lit(1)).alias("total_count"),
                 F.count_if(bad).alias("corrupt_count"),
                 F.count_if(~bad).alias("valid_count"))


@register("corrupt_threshold", f"""WITH {SQL_LINES}
SELECT count(*) FILTER (WHERE is_corrupt) AS corrupt_count, count(*) AS total_count,
       coalesce(count(*) FILTER (WHERE is_corrupt) * 1.0 / nullif(count(*), 0), 0.0) AS corrupt_ratio,
       coalesce(count(*) FILTER (WHERE is_corrupt) * 1.0 / nullif(count(*), 0), 0.0) > {CORRUPT_ALARM_RATIO}
         AS alarm
FROM parsed""")
def q_corrupt_threshold(spark, sf_dir):
    p = parsed_events(spark, sf_dir)
    return p.agg(*corrupt_threshold(F.count(F.lit(1)), F.count_if(F.col(CORRUPT_COL).isNotNull()),
                                    CORRUPT_ALARM_RATIO))


@register("require_not_null", f"""WITH {SQL_LINES}
SELECT event_id, session_id, user_id, event_type FROM clean""")
def q_require_not_null(spark, sf_dir):
    v = valid_events(spark, sf_dir)
    return require_not_null(v, silver.EVENT_KEYS).select("event_id", "session_id", "user_id", "event_type")


@register("silver_events", f"""WITH {SQL_LINES}
SELECT event_id, session_id, user_id, event_type, event_timestamp, price FROM dedup""")
def q_silver_events(spark, sf_dir):
    return _event_out(silver.events_clean(valid_events(spark, sf_dir), extra_cols=()))


@register("dedup_latest_events", f"""WITH {SQL_LINES}
SELECT event_id, event_timestamp, price FROM dedup""")
def q_dedup_latest_events(spark, sf_dir):
    return _event_out(silver.events_clean(valid_events(spark, sf_dir), extra_cols=())).select(
        "event_id", "event_timestamp", "price")


@register("duplicates_removed", f"""WITH {SQL_LINES}
SELECT (SELECT count(*) FROM parsed) AS input_rows,
       (SELECT count(*) FROM parsed WHERE is_corrupt) AS corrupt_rows,
       (SELECT count(*) FROM parsed WHERE NOT is_corrupt) - (SELECT count(*) FROM clean) AS null_key_dropped,
       (SELECT count(*) FROM clean) - (SELECT count(*) FROM dedup) AS duplicates_removed,
       (SELECT count(*) FROM dedup) AS output_rows""")
def q_duplicates_removed(spark, sf_dir):
    """Stage counts in one aggregate pass over the parsed lines (the kept
    count is the number of distinct ids among clean rows)."""
    p = parsed_events(spark, sf_dir)
    corrupt = F.col(CORRUPT_COL).isNotNull()
    keys_ok = F.col("event_id").isNotNull() & F.col("user_id").isNotNull() \
        & F.col("session_id").isNotNull() & F.col("event_type").isNotNull()
    clean = ~corrupt & keys_ok
    return p.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(corrupt).alias("corrupt_rows"),
        F.count_if(~corrupt & ~keys_ok).alias("null_key_dropped"),
        F.count_if(clean).alias("_clean"),
        F.count_distinct(F.when(clean, F.col("event_id"))).alias("output_rows"),
    ).select("input_rows", "corrupt_rows", "null_key_dropped",
             (F.col("_clean") - F.col("output_rows")).alias("duplicates_removed"), "output_rows")


# ------------------------------------------------------------- transactions

SQL_TX = """
p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
rawtx AS (
  SELECT event_id, user_id, ts, value FROM p
  UNION ALL SELECT event_id, user_id, ts + INTERVAL 1 SECOND, value + 1.0 FROM p WHERE event_id % 50 = 0
),
typed AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         CAST(user_id AS VARCHAR) AS user_id,
         CAST(printf('%.2f', value) AS DOUBLE) AS amount,
         ' USD ' AS currency_raw,
         date_trunc('second', ts) AS transaction_timestamp
  FROM rawtx
),
txclean AS (
  SELECT transaction_id, session_id, user_id, amount, trim(currency_raw) AS currency, transaction_timestamp
  FROM typed
  WHERE transaction_id IS NOT NULL AND session_id IS NOT NULL AND user_id IS NOT NULL
    AND amount IS NOT NULL AND amount > 0
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_timestamp DESC NULLS LAST,
          session_id DESC, user_id DESC, amount DESC, currency DESC) = 1
)"""


def _tx_raw(spark, sf_dir):
    return parse_csv_lines(landing.transaction_csv_lines(spark, sf_dir), "value", RAW_TRANSACTION)


@register("read_csv", f"""WITH {SQL_TX}
SELECT transaction_id, session_id, user_id, amount, currency_raw AS currency,
       strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp
FROM typed""")
def q_read_csv(spark, sf_dir):
    return _tx_raw(spark, sf_dir)


@register("silver_transactions", f"""WITH {SQL_TX}
SELECT transaction_id, session_id, user_id, amount, currency, transaction_timestamp FROM txclean""")
def q_silver_transactions(spark, sf_dir):
    t = silver.transactions_clean(_tx_raw(spark, sf_dir))
    return t.withColumn("transaction_timestamp", to_ntz("transaction_timestamp"))


@register("dedup_latest_transactions", f"""WITH {SQL_TX}
SELECT transaction_id, amount, transaction_timestamp FROM txclean""")
def q_dedup_latest_transactions(spark, sf_dir):
    t = silver.transactions_clean(_tx_raw(spark, sf_dir))
    return t.select("transaction_id", "amount", to_ntz("transaction_timestamp").alias("transaction_timestamp"))


@register("positive_amount", f"""WITH {SQL_TX}
SELECT count(*) FILTER (WHERE amount > 0) AS kept, count(*) FILTER (WHERE NOT amount > 0) AS dropped
FROM typed WHERE amount IS NOT NULL""")
def q_positive_amount(spark, sf_dir):
    t = _tx_raw(spark, sf_dir).filter(F.col("amount").isNotNull())
    return t.agg(F.count_if(F.col("amount") > 0).alias("kept"),
                 F.count_if(~(F.col("amount") > 0)).alias("dropped"))


# -------------------------------------------------------------------- users

SQL_USERS = """
u AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS user_id, fo.first_order AS signup_ts,
         ' ' || c.c_mktsegment AS device_raw, n.n_name || ' ' AS country_raw
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) fo
         ON c.c_custkey = fo.o_custkey
),
ud AS (
  SELECT DISTINCT user_id, CAST(signup_ts AS DATE) AS signup_date,
         trim(device_raw) AS device_type, trim(country_raw) AS country
  FROM u WHERE user_id IS NOT NULL
)"""


def _users_raw(spark, sf_dir):
    return parse_csv_lines(landing.user_csv_lines(spark, sf_dir), "value", RAW_USER)


@register("users_dim", f"""WITH {SQL_USERS}
SELECT * FROM ud QUALIFY row_number() OVER (PARTITION BY user_id
       ORDER BY signup_date DESC NULLS LAST, device_type DESC, country DESC) = 1""")
def q_users_dim(spark, sf_dir):
    return silver.users_dim(_users_raw(spark, sf_dir))


@register("distinct_rows", f"WITH {SQL_USERS} SELECT * FROM ud")
def q_distinct_rows(spark, sf_dir):
    return silver.users_distinct(_users_raw(spark, sf_dir))


@register("trim_strings", f"""WITH {SQL_USERS}
SELECT user_id, trim(device_raw) AS device_type, trim(country_raw) AS country,
       length(device_raw) - length(trim(device_raw)) AS device_trimmed,
       length(country_raw) - length(trim(country_raw)) AS country_trimmed
FROM u""")
def q_trim_strings(spark, sf_dir):
    r = _users_raw(spark, sf_dir)
    return r.select("user_id", F.trim("device_type").alias("device_type"), F.trim("country").alias("country"),
                    (F.length("device_type") - F.length(F.trim("device_type"))).alias("device_trimmed"),
                    (F.length("country") - F.length(F.trim("country"))).alias("country_trimmed"))


@register("parse_date", f"""WITH {SQL_USERS}
SELECT user_id, CAST(signup_ts AS DATE) AS signup_date FROM u""")
def q_parse_date(spark, sf_dir):
    from strata.functions.scalar import parse_date
    return _users_raw(spark, sf_dir).select("user_id", parse_date("signup_date").alias("signup_date"))


@register("row_counts", f"""WITH {SQL_LINES}, {SQL_TX}, {SQL_USERS}
SELECT 'events_raw' AS stage, count(*) AS row_count FROM parsed
UNION ALL SELECT 'events_clean', count(*) FROM dedup
UNION ALL SELECT 'transactions_raw', count(*) FROM typed
UNION ALL SELECT 'transactions_clean', count(*) FROM txclean
UNION ALL SELECT 'users_raw', count(*) FROM u
UNION ALL SELECT 'users_dim', count(*) FROM ud""")
def q_row_counts(spark, sf_dir):
    parts = [
        ("events_raw", parsed_events(spark, sf_dir)),
        ("events_clean", silver.events_clean(valid_events(spark, sf_dir), extra_cols=())),
        ("transactions_raw", _tx_raw(spark, sf_dir)),
        ("transactions_clean", silver.transactions_clean(_tx_raw(spark, sf_dir))),
        ("users_raw", _users_raw(spark, sf_dir)),
        ("users_dim", silver.users_dim(_users_raw(spark, sf_dir))),
    ]
    out = None
    for stage, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(stage).alias("stage"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


@register("stamp_processing_time", f"""WITH {SQL_LINES}
SELECT count(*) AS rows, 1 AS distinct_stamps, true AS all_stamped FROM dedup""")
def q_stamp_processing_time(spark, sf_dir):
    """Audit column: one processing time per load, on every silver row (the
    stamp itself differs per run, so only its shape is compared)."""
    df = silver.events_clean(valid_events(spark, sf_dir), stamp=True, extra_cols=())
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct("processing_timestamp").alias("distinct_stamps"),
                  F.bool_and(F.col("processing_timestamp").isNotNull()).alias("all_stamped"))
