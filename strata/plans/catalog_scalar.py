"""Registered projection / filter / scalar-expression queries, one per
inventory item, each over the whole cleaned or gold data."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import scalar
from strata.functions.scalar import to_ntz
from strata.plans import gold, silver
from strata.plans.catalog_gold import SQL_G, SQL_SILVER, silver_inputs
from strata.plans.catalog_silver import SQL_LINES, valid_events
from strata.registry import register
from strata.session import new_path
from strata.sources import landing
from strata.streaming import jobs

# Fixed value: rows in the sample report.
SAMPLE_ROWS = 5


def _gold(spark, sf_dir):
    e, t, u, bound = silver_inputs(spark, sf_dir)
    return gold.user_session_analysis(e, t, u, bound, stamp=False)


@register("project_final", f"""WITH {SQL_SILVER}
SELECT event_id, session_id, user_id, event_type, ts AS event_timestamp, value FROM ev""")
def q_project_final(spark, sf_dir):
    e = silver.events_clean(landing.app_events(spark, sf_dir))
    return e.select("event_id", "session_id", "user_id", "event_type",
                    to_ntz("event_timestamp").alias("event_timestamp"), "value")


@register("boolean_filter", f"""{SQL_G}
SELECT session_id, user_id, transaction_id FROM g WHERE has_transaction""")
def q_boolean_filter(spark, sf_dir):
    return _gold(spark, sf_dir).filter("has_transaction").select("session_id", "user_id", "transaction_id")


@register("parse_timestamp", f"""WITH {SQL_LINES}
SELECT event_id, event_timestamp FROM parsed WHERE NOT is_corrupt""")
def q_parse_timestamp(spark, sf_dir):
    v = valid_events(spark, sf_dir)
    return v.select("event_id", to_ntz(scalar.parse_timestamp("event_timestamp")).alias("event_timestamp"))


@register("cast_decimal", f"""WITH {SQL_SILVER}
SELECT transaction_id, CAST(amount AS DECIMAL(10,2)) AS transaction_amount FROM tx""")
def q_cast_decimal(spark, sf_dir):
    _, t, _, _ = silver_inputs(spark, sf_dir)
    return t.select("transaction_id", scalar.to_money("amount").alias("transaction_amount"))


@register("cast_int", f"""{SQL_G}
SELECT session_id, user_id, total_events, session_duration_seconds FROM g""")
def q_cast_int(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return g.select("session_id", "user_id", scalar.to_int("total_events").alias("total_events"),
                    scalar.to_int("session_duration_seconds").alias("session_duration_seconds"))


@register("drop_rename", f"""WITH {SQL_SILVER}
SELECT transaction_id, session_id, user_id, CAST(amount AS DECIMAL(10,2)) AS transaction_amount,
       currency AS transaction_currency, transaction_timestamp FROM tx""")
def q_drop_rename(spark, sf_dir):
    t = silver.transactions_clean(landing.app_transactions(spark, sf_dir), stamp=True)
    out = (t.drop("processing_timestamp")
           .withColumn("amount", scalar.to_money("amount"))
           .withColumnsRenamed({"amount": "transaction_amount", "currency": "transaction_currency"}))
    return out.withColumn("transaction_timestamp", to_ntz("transaction_timestamp"))


@register("flag_case", f"{SQL_G}\nSELECT session_id, user_id, has_transaction FROM g")
def q_flag_case(spark, sf_dir):
    return _gold(spark, sf_dir).select("session_id", "user_id", "has_transaction")


@register("duration_seconds", f"{SQL_G}\nSELECT session_id, user_id, session_duration_seconds FROM g")
def q_duration_seconds(spark, sf_dir):
    return _gold(spark, sf_dir).select("session_id", "user_id", "session_duration_seconds")


@register("time_to_purchase", f"{SQL_G}\nSELECT session_id, user_id, time_to_purchase_seconds FROM g")
def q_time_to_purchase(spark, sf_dir):
    return _gold(spark, sf_dir).select("session_id", "user_id", "time_to_purchase_seconds")


@register("session_date", f"{SQL_G}\nSELECT session_id, user_id, session_date FROM g")
def q_session_date(spark, sf_dir):
    return _gold(spark, sf_dir).select("session_id", "user_id", "session_date")


@register("constant_columns", f"{SQL_G}\nSELECT session_id, user_id, data_version, source_system FROM g")
def q_constant_columns(spark, sf_dir):
    return _gold(spark, sf_dir).select("session_id", "user_id", "data_version", "source_system")


@register("nested_fields", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       value AS price FROM events""")
def q_nested_fields(spark, sf_dir):
    e = landing.app_events(spark, sf_dir)
    return e.select("event_id", F.col("event_details.k").alias("k"), F.col("value").alias("price"))


@register("show_sample", f"""{SQL_G}
SELECT user_id, session_id, session_start_time, total_events, event_path, has_transaction FROM g
ORDER BY session_start_time, session_id LIMIT {SAMPLE_ROWS}""")
def q_show_sample(spark, sf_dir):
    """The first sessions by start time (a top-k report: the limit is the
    feature; Spark plans it as a per-partition top-k, no full sort)."""
    g = gold.comparable(_gold(spark, sf_dir))
    return (g.orderBy("session_start_time", "session_id").limit(SAMPLE_ROWS)
            .select("user_id", "session_id", "session_start_time", "total_events", "event_path",
                    "has_transaction"))


@register("stream_read", "SELECT event_id, ts, user_id, event_type FROM events")
def q_stream_read(spark, sf_dir):
    """The given events read as a file stream (schema declared, offsets in
    a checkpoint), drained with availableNow into a parquet sink."""
    s = jobs.parquet_stream(spark, sf_dir.rstrip("/"), "events.parquet")
    out, ck = new_path(spark, "stream_read"), new_path(spark, "ck")
    q = (s.select("event_id", "ts", "user_id", "event_type").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
