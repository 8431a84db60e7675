import datetime as dt

from pyspark.sql import functions as F

from strata.operators.cleaning import latest_per_key, require_not_null, split_corrupt
from strata.plans import silver
from strata.sources.readers import parse_json_lines, read_events_json

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def test_dedup_tie_is_deterministic(spark):
    rows = [(1, T0, "a", 1.0), (1, T0, "b", 2.0), (2, T0, "x", 1.0)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, payload string, v double")
    results = set()
    for n in (1, 3, 7):
        out = latest_per_key(df.repartition(n), "id", "ts").orderBy("id").collect()
        results.add(tuple(tuple(r) for r in out))
    assert len(results) == 1
    (first, _), = [(r, None) for r in results]
    assert first[0][2] == "b"  # tie broken on remaining columns, descending


def test_dedup_null_timestamp_loses(spark):
    rows = [(1, None, "old"), (1, T0, "new")]
    df = spark.createDataFrame(rows, "id long, ts timestamp, payload string")
    assert latest_per_key(df, "id", "ts").first()["payload"] == "new"


def test_require_not_null_keeps_null_timestamps(spark):
    rows = [("e1", "s", "u", "view", None), ("e2", None, "u", "view", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "event_id string, session_id string, user_id string, "
                                     "event_type string, event_timestamp string")
    kept = require_not_null(df, silver.EVENT_KEYS).collect()
    assert [r["event_id"] for r in kept] == ["e1"]


def test_corrupt_json_split(spark, tmp_path):
    p = tmp_path / "events.json"
    p.write_text('{"event_id":"e1","session_id":"s1","user_id":"u1","event_type":"view",'
                 '"event_timestamp":"2024-01-01T10:00:00"}\n{"event_id": "e2", broken\n')
    df = read_events_json(spark, str(p))
    valid, bad = split_corrupt(df)
    assert valid.count() == 1 and bad.count() == 1
    assert bad.first()[0].startswith('{"event_id": "e2"')


def test_no_corrupt_lines(spark):
    lines = spark.createDataFrame([('{"event_id":"e1"}',)], "value string")
    valid, bad = split_corrupt(parse_json_lines(lines))
    assert valid.count() == 1 and bad.count() == 0


def test_unparseable_timestamp_becomes_null_row_kept(spark):
    raw = spark.createDataFrame(
        [("e1", "s", "u", "view", "not a time", None)],
        "event_id string, session_id string, user_id string, event_type string, "
        "event_timestamp string, event_details struct<price:double>")
    out = silver.events_clean(raw).collect()
    assert len(out) == 1 and out[0]["event_timestamp"] is None


def test_transactions_amount_rules(spark):
    rows = [("t1", "s", "u", 0.0, " USD ", "2024-01-01 10:00:00"),
            ("t2", "s", "u", -5.0, "USD", "2024-01-01 10:00:00"),
            ("t3", "s", "u", None, "USD", "2024-01-01 10:00:00"),
            ("t4", "s", "u", 10.0, " PEN ", "2024-01-01 10:00:00")]
    raw = spark.createDataFrame(rows, "transaction_id string, session_id string, user_id string, "
                                      "amount double, currency string, transaction_timestamp string")
    out = silver.transactions_clean(raw).collect()
    assert [(r["transaction_id"], r["currency"]) for r in out] == [("t4", "PEN")]


def test_users_dim_one_row_per_user(spark):
    rows = [("u1", "2024-01-01 09:00:00", " iOS", "PE "), ("u1", "2024-02-01 09:00:00", "Web", "MX"),
            ("u1", "2024-02-01 09:00:00", "Web", "MX"), (None, "2024-01-01 00:00:00", "Web", "MX")]
    raw = spark.createDataFrame(rows, "user_id string, signup_date string, device_type string, country string")
    assert silver.users_distinct(raw).count() == 2          # the reference's distinct keeps both
    dim = silver.users_dim(raw).collect()
    assert len(dim) == 1 and dim[0]["device_type"] == "Web"
    assert dim[0]["signup_date"] == dt.date(2024, 2, 1)


def test_trim(spark):
    raw = spark.createDataFrame([("u1", None, "  iOS ", " PE")],
                                "user_id string, signup_date string, device_type string, country string")
    r = silver.users_dim(raw).first()
    assert (r["device_type"], r["country"]) == ("iOS", "PE")
    assert raw.select(F.trim("device_type")).first()[0] == "iOS"
