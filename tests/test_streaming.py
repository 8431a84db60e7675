"""Streaming gold upsert on literal arrivals: late events, a re-delivery and
a session spanning midnight; the stream's gold equals the batch gold over
all lines."""

import collections
import datetime as dt
import json
import os

from strata.operators.cleaning import latest_per_key, split_corrupt
from strata.plans import gold
from strata.sources.readers import parse_json_lines
from strata.sources.schemas import CORRUPT_COL, LANDED_EVENT
from strata.streaming import jobs
from strata.tables.writes import list_partitions

TXS = "transaction_id string, session_id string, user_id long, amount double, currency string, " \
      "transaction_timestamp timestamp"
USS = "user_id long, signup_date date, device_type string, country string"


def _line(eid, sid, uid, typ, ts, price=None):
    return json.dumps({"event_id": eid, "session_id": sid, "user_id": uid, "event_type": typ,
                       "event_timestamp": ts, "event_details": {"price": price}})


def test_stream_gold_upsert_matches_batch(spark, tmp_path):
    b1 = [_line(1, "s1", 7, "view", "2024-01-02 10:00:00"), _line(2, "s1", 7, "click", "2024-01-02 10:05:00"),
          _line(3, "s2", 8, "view", "2024-01-03 09:00:00"), _line(4, "s2", 8, "search", "2024-01-03 09:10:00"),
          _line(10, "s3", 9, "view", "2024-01-05 23:30:00"), _line(11, "s3", 9, "click", "2024-01-06 00:10:00")]
    b2 = [_line(5, "s1", 7, "login", "2024-01-01 23:50:00"),            # late: s1 now starts a day earlier
          _line(6, "s1", 7, "checkout", "2024-01-02 11:00:00"),
          _line(4, "s2", 8, "purchase", "2024-01-03 09:20:00", 12.5),   # re-delivery: newer copy wins
          _line(12, "s3", 9, "search", "2024-01-06 00:20:00")]          # s3's first event is on an older date
    src = tmp_path / "landing"
    src.mkdir()
    for i, batch in enumerate([b1, b2]):
        f = src / f"part-{i}.json"
        f.write_text("\n".join(batch) + "\n")
        os.utime(f, (1_700_000_000 + 100 * i,) * 2)                    # arrival order
    tx = spark.createDataFrame([("t1", "s2", 8, 12.5, "USD", dt.datetime(2024, 1, 3, 9, 20))], TXS)
    users = spark.createDataFrame([(7, dt.date(2023, 5, 1), "ios", "PE"), (8, dt.date(2023, 6, 1), "web", "MX"),
                                   (9, dt.date(2023, 7, 1), "android", "CL")], USS)
    gold_path = str(tmp_path / "gold")
    q = jobs.gold_upsert(jobs.json_line_stream(spark, str(src), max_files_per_trigger=1),
                         str(tmp_path / "silver"), gold_path, str(tmp_path / "ck"), tx, users)
    q.awaitTermination()
    assert q.exception() is None
    got = gold.comparable(spark.read.parquet(gold_path))

    valid, _ = split_corrupt(parse_json_lines(spark.read.text(str(src)), "value", LANDED_EVENT, CORRUPT_COL))
    events = latest_per_key(jobs.clean_events(valid), "event_id", "event_timestamp")
    exp = gold.comparable(gold.user_session_analysis(events, tx, users))
    assert sorted(got.collect()) == sorted(exp.collect())

    rows = {r["session_id"]: r for r in got.collect()}
    assert str(rows["s1"]["session_date"]) == "2024-01-01" and rows["s1"]["total_events"] == 4
    assert rows["s3"]["total_events"] == 3
    assert rows["s2"]["has_transaction"]
    # s1 left 2024-01-02, which then held no session: that partition is gone
    assert list_partitions(spark, gold_path, "session_date") == ["2024-01-01", "2024-01-03", "2024-01-05"]


def test_streams_of_events_and_purchases_match_batch(spark, tmp_path):
    """A purchase that arrives after its session, and an event that moves to
    another session: the streams' gold equals the batch gold."""
    from strata.plans import medallion
    from strata.sources.schemas import RAW_TRANSACTION
    paths = medallion.table_paths(str(tmp_path / "lake"))
    users = spark.createDataFrame([(7, dt.date(2023, 5, 1), "ios", "PE"), (8, dt.date(2023, 6, 1), "web", "MX")], USS)
    medallion.merge_load(spark, paths, users=users)
    schema = type(RAW_TRANSACTION)([f if f.name != "user_id" else type(f)("user_id", LANDED_EVENT["user_id"].dataType)
                                    for f in RAW_TRANSACTION.fields])

    def arrive(name, number, text, clean):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        (folder / f"part-{number}").write_text("\n".join(text) + "\n")
        q = jobs.load_stream(jobs.json_line_stream(spark, str(folder)), name, paths, str(tmp_path / f"ck-{name}"), clean)
        q.awaitTermination()
        assert q.exception() is None

    purchases = jobs.newest_purchases(schema)
    e1 = [_line(1, "s1", 7, "view", "2024-01-02 10:00:00"), _line(2, "s2", 8, "view", "2024-01-03 09:00:00"),
          _line(3, "s9", 8, "view", "2024-01-04 09:00:00")]
    e2 = [_line(3, "s2", 8, "click", "2024-01-04 09:00:01"), _line(4, "s1", 7, "click", "2024-01-02 10:30:00")]
    t1, t2 = ["t1,s1,7,12.50,USD,2024-01-02 10:20:00"], ["t2,s2,8,1.00,USD,2024-01-03 09:05:00", "t1,s1,7,13.50,USD,2024-01-02 10:21:00"]
    arrive("events_clean", 0, e1, jobs.newest_landed_events)
    arrive("transactions_clean", 0, t1, purchases)
    arrive("events_clean", 1, e2, jobs.newest_landed_events)
    arrive("transactions_clean", 1, t2, purchases)

    lines = lambda rows: spark.createDataFrame([(r,) for r in rows], "value string")
    want = gold.comparable(gold.user_session_analysis(jobs.newest_landed_events(lines(e1 + e2)), purchases(lines(t1 + t2)), users))
    got = gold.comparable(spark.read.parquet(paths["user_session_analysis"]))
    assert sorted(got.collect()) == sorted(want.collect())
    assert {r["session_id"] for r in got.collect()} == {"s1", "s2"}           # s9 lost its only event


def test_gold_stream_has_six_batches_whatever_the_size(spark, tmp_path, monkeypatch):
    """More lines make larger arrivals, not more merges into the same dates."""
    from strata.plans import catalog_streaming, medallion
    from strata.sources import landing
    at = dt.datetime(2024, 1, 1)
    rows = [(i, at + dt.timedelta(minutes=10 * i), i % 3, "purchase" if i % 7 == 0 else "view", float(i), "{}") for i in range(120)]
    tables = {"events": (rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
              "customer": ([(i, 1, "AUTO") for i in range(3)], "c_custkey long, c_nationkey int, c_mktsegment string"),
              "nation": ([(1, "PERU")], "n_nationkey int, n_name string"),
              "orders": ([(1, dt.date(2023, 1, 1))], "o_custkey long, o_orderdate date")}
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    merged, merge = [], medallion.merge_load
    monkeypatch.setattr(medallion, "merge_load", lambda *a, **kw: merged.append(1) or merge(*a, **kw))
    monkeypatch.setattr(landing, "ARRIVAL_ROWS", 10)                # twelve files
    got = catalog_streaming.q_stream_upsert_gold(spark, str(tmp_path))
    assert len(merged) == 6
    kept = [r for r in rows if r[0] % 97 and r[0] % 89]             # neither truncated nor without a session
    assert {r["session_id"]: r["total_events"] for r in got.collect()} == {
        s: n for s, n in collections.Counter(f"{r[2]}_{r[1].date()}" for r in kept).items()}
