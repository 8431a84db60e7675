import datetime as dt
from decimal import Decimal

from strata.operators.sessions import session_aggregate
from strata.plans import gold

T = lambda h, m=0: dt.datetime(2024, 1, 1, h, m, 0)

EV = "event_id string, session_id string, user_id string, event_type string, event_timestamp timestamp"
TX = ("transaction_id string, session_id string, user_id string, amount double, currency string, "
      "transaction_timestamp timestamp")
US = "user_id string, signup_date date, device_type string, country string"


def _frames(spark, events, txns, users):
    return (spark.createDataFrame(events, EV), spark.createDataFrame(txns, TX),
            spark.createDataFrame(users, US))


def test_session_order_and_counts(spark):
    events = [("e3", "s1", "u1", "checkout", T(10, 5)), ("e1", "s1", "u1", "view", T(10)),
              ("e2", "s1", "u1", "click", T(10, 1)), ("e4", "s1", "u1", "late", None)]
    e = spark.createDataFrame(events, EV)
    for n in (1, 4):
        r = session_aggregate(e.repartition(n)).first()
        assert r["event_types"] == ["view", "click", "checkout"]
        assert (r["first_event_type"], r["last_event_type"]) == ("view", "checkout")
        assert r["total_events"] == 4                     # NULL-time row counted, not in the path
        assert r["session_duration_seconds"] == 300


def test_two_purchases_fanout_vs_first(spark):
    e, t, u = _frames(spark,
                      [("e1", "s1", "u1", "view", T(10))],
                      [("t1", "s1", "u1", 10.0, "USD", T(10, 30)), ("t2", "s1", "u1", 5.0, "USD", T(10, 20))],
                      [("u1", dt.date(2023, 5, 1), "iOS", "PE")])
    first = gold.user_session_analysis(e, t, u).collect()
    assert len(first) == 1 and first[0]["transaction_id"] == "t2"
    assert first[0]["transaction_amount"] == Decimal("5.00")
    assert first[0]["time_to_purchase_seconds"] == 1200
    assert gold.gold_fanout(e, t, u).count() == 2


def test_purchase_before_start_orphan_and_missing_user(spark):
    e, t, u = _frames(spark,
                      [("e1", "s1", "u1", "view", T(10)), ("e2", "s2", "u9", "view", T(11))],
                      [("t1", "s1", "u1", 1.0, "USD", T(9, 59)), ("t9", "s_none", "u1", 1.0, "USD", T(12))],
                      [("u1", None, "Web", "MX")])
    rows = {r["session_id"]: r for r in gold.user_session_analysis(e, t, u).collect()}
    assert rows["s1"]["time_to_purchase_seconds"] == -60
    assert rows["s2"]["country"] is None and rows["s2"]["has_transaction"] is False
    assert len(rows) == 2                                  # the orphan purchase does not appear


def test_amount_overflow_is_null(spark):
    e, t, u = _frames(spark, [("e1", "s1", "u1", "view", T(10))],
                      [("t1", "s1", "u1", 123456789.0, "USD", T(10))], [])
    r = gold.user_session_analysis(e, t, spark.createDataFrame([], US)).first()
    assert r["transaction_id"] == "t1" and r["transaction_amount"] is None


def test_metrics_empty_input(spark):
    empty = spark.createDataFrame([], "has_transaction boolean")
    r = gold.gold_metrics(empty).first()
    assert (r["total_sessions"], r["conversion_rate_pct"]) == (0, 0.0)
