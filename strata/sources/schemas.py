"""Explicit schemas for the raw (bronze) sources.

Schemas are declared, never inferred: inference costs an extra pass over the
input, changes type with the data, and mis-types id columns in CSV.
"""

from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"

# Payload of an app event, the union of the per-type detail fields.
EVENT_DETAILS = T.StructType([
    T.StructField("action", T.StringType()),
    T.StructField("element_id", T.StringType()),
    T.StructField("element_type", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("results_count", T.LongType()),
    T.StructField("search_query", T.StringType()),
])

# Raw JSON line of an app event, plus the column that keeps malformed lines.
RAW_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("event_details", EVENT_DETAILS),
    T.StructField(CORRUPT_COL, T.StringType()),
])

# Raw JSON line of an event landed from the given events table (numeric ids).
LANDED_EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("event_details", T.StructType([T.StructField("price", T.DoubleType())])),
    T.StructField(CORRUPT_COL, T.StringType()),
])

RAW_TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("transaction_timestamp", T.StringType()),
])

RAW_USER = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("signup_date", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("country", T.StringType()),
])

# Columns the cleaned tables must carry (validated before any write).
EVENTS_CLEAN_COLUMNS = ["event_id", "session_id", "user_id", "event_type",
                        "event_timestamp", "event_details"]

# Gold table columns in order, as in the published table definition.
GOLD_COLUMNS = [
    "user_id", "session_id", "signup_date", "device_type", "country",
    "session_start_time", "session_end_time", "session_duration_seconds", "session_date",
    "total_events", "event_types", "first_event_type", "last_event_type",
    "transaction_id", "transaction_amount", "transaction_currency", "transaction_timestamp",
    "has_transaction", "time_to_purchase_seconds",
    "processing_timestamp", "data_version", "source_system",
]
