"""Stateful streams on literal arrivals: corrections, expiry, sessions that a
late event extends or joins, closing by timer, and a restart."""

import datetime as dt
import os

from strata.streaming import stateful

E = "event_id long, user_id long, event_type string, event_timestamp timestamp, value double"


def _at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def _arrive(spark, folder, k, rows):
    tmp = f"{folder}-{k}"
    spark.createDataFrame(rows, E).coalesce(1).write.parquet(tmp)
    os.makedirs(folder, exist_ok=True)
    part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    os.rename(f"{tmp}/{part}", f"{folder}/{k}.parquet")
    os.utime(f"{folder}/{k}.parquet", (1_700_000_000 + 100 * k,) * 2)


def _run(spark, tmp_path, make):
    stream = spark.readStream.schema(E).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with stateful.state_store(spark):
        q = stateful.run_to_parquet(make(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
        q.awaitTermination()
    assert q.exception() is None
    return spark.read.parquet(str(tmp_path / "out")).drop("batch")


def test_newest_copy_wins_whatever_comes_first(spark, tmp_path):
    src = str(tmp_path / "in")
    _arrive(spark, src, 0, [(1, 7, "b", _at(1, 10), 2.0), (2, 7, "x", _at(1, 10), None), (1, 7, "a", _at(1, 10), 3.0)])
    _arrive(spark, src, 1, [(1, 7, "c", _at(1, 11), 1.0), (2, 7, "x", _at(1, 9, 55), 5.0)])      # a correction, an older copy
    _arrive(spark, src, 2, [(3, 7, "z", _at(5), 1.0)])                                            # moves the watermark on
    dedup = lambda s: stateful.dedup_newest(s, "event_id", "event_timestamp", "1 hour", 3_600_000)
    emitted = _run(spark, tmp_path, dedup)
    rows = {r["event_id"]: (r["event_type"], r["value"]) for r in stateful.current_rows(emitted, ["event_id"]).collect()}
    assert rows == {1: ("c", 1.0), 2: ("x", None), 3: ("z", 1.0)}
    assert sorted((r["event_id"], r["version"]) for r in emitted.collect()) == [(1, 1), (1, 2), (2, 1), (3, 1)]
    _arrive(spark, src, 3, [(3, 7, "y", _at(5), 9.0), (1, 7, "late", _at(1, 12), 0.0)])           # after a restart; behind the watermark
    rows = {r["event_id"]: r["event_type"] for r in stateful.current_rows(_run(spark, tmp_path, dedup), ["event_id"]).collect()}
    assert rows == {1: "c", 2: "x", 3: "z"}


def test_late_event_joins_sessions_and_timer_closes_them(spark, tmp_path):
    src = str(tmp_path / "in")
    _arrive(spark, src, 0, [(1, 7, "a", _at(1, 10), 0.0), (2, 7, "b", _at(1, 12), 0.0), (3, 8, "q", _at(1, 10), 0.0), (9, 8, "n", None, 0.0)])
    _arrive(spark, src, 1, [(4, 7, "m", _at(1, 11), 0.0), (5, 7, "f", _at(1, 9, 30), 0.0)])       # joins both, and extends to the left
    _arrive(spark, src, 2, [(6, 9, "z", _at(9), 0.0)])
    _arrive(spark, src, 3, [(7, 9, "z", _at(9, 0, 10), 0.0)])
    emitted = _run(spark, tmp_path, lambda s: stateful.open_sessions(s, 3601, "1 day"))
    last = {(r["user_id"], r["session_start_time"]): r for r in stateful.current_rows(emitted, ["user_id", "session_start_time"]).collect()}
    assert set(last) == {(7, _at(1, 9, 30)), (8, _at(1, 10)), (9, _at(9))}
    joined = last[7, _at(1, 9, 30)]
    assert (joined["session_end_time"], joined["total_events"], joined["first_event_type"], joined["last_event_type"]) == (_at(1, 12), 4, "f", "b")
    assert {u: r["closed"] for (u, _), r in last.items()} == {7: True, 8: True, 9: False}
    assert last[9, _at(9)]["total_events"] == 2
    gone = {(r["user_id"], r["session_start_time"]) for r in emitted.filter("retracted").collect()}
    assert gone == {(7, _at(1, 10)), (7, _at(1, 12))}


def _calls(spark, tmp_path, processor, make, monkeypatch):
    """Emissions, and the number of calls of the processor."""
    log = str(tmp_path / "calls")

    class Counted(processor):
        def handleInputRows(self, key, rows, timerValues):
            with open(log, "a") as f:
                f.write("x")
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(stateful, processor.__name__, Counted)
    emitted = _run(spark, tmp_path, make)
    return emitted, os.path.getsize(log)


def test_a_call_takes_many_keys(spark, tmp_path, monkeypatch):
    """A micro-batch calls the processor once per bucket, not once per key."""
    rows = [(i, i, "v", _at(1, 10, i % 60), float(i)) for i in range(300)]
    _arrive(spark, str(tmp_path / "in"), 0, [*rows, *((i, 0, "w", _at(1, 11), 0.0) for i in range(0, 300, 50))])
    got, calls = _calls(spark, tmp_path, stateful._Newest, lambda s: stateful.dedup_newest(s, "event_id", "event_timestamp", "1 hour", 3_600_000, 4), monkeypatch)
    assert calls == 4
    assert {r["event_id"]: r["event_type"] for r in got.collect()} == {i: "w" if i % 50 == 0 else "v" for i in range(300)}


def test_users_of_a_bucket_keep_their_sessions_apart(spark, tmp_path, monkeypatch):
    """Every user in one bucket: late events extend, join and retract sessions
    of their own user only; a user without an id is a user, a large id stays."""
    big = 2 ** 53 + 1
    _arrive(spark, str(tmp_path / "in"), 0, [(1, 7, "a", _at(1, 10), 0.0), (2, 7, "b", _at(1, 12), 0.0), (3, 8, "q", _at(1, 10, 30), 0.0),
                                             (4, None, "n", _at(1, 10), 0.0), (5, big, "g", _at(1, 10), 0.0), (6, 0, "o", _at(1, 10), 0.0)])
    _arrive(spark, str(tmp_path / "in"), 1, [(7, 7, "m", _at(1, 11), 0.0), (8, 8, None, _at(1, 10, 30), 0.0), (9, None, "m", _at(1, 10, 10), 0.0)])
    emitted, calls = _calls(spark, tmp_path, stateful._OpenSessions, lambda s: stateful.open_sessions(s, 3601, "1 day", 1), monkeypatch)
    assert calls <= 4                                                              # ids are in one bucket, whatever the batch
    got = {(r["user_id"], r["session_start_time"]): (r["session_end_time"], r["total_events"], r["first_event_type"], r["last_event_type"])
           for r in stateful.current_rows(emitted, ["user_id", "session_start_time"]).collect()}
    assert got == {(7, _at(1, 10)): (_at(1, 12), 3, "a", "b"), (8, _at(1, 10, 30)): (_at(1, 10, 30), 2, "q", None),
                   (None, _at(1, 10)): (_at(1, 10, 10), 2, "n", "m"), (big, _at(1, 10)): (_at(1, 10), 1, "g", "g"), (0, _at(1, 10)): (_at(1, 10), 1, "o", "o")}
    assert [(r["user_id"], r["session_start_time"]) for r in emitted.filter("retracted").collect()] == [(7, _at(1, 12))]


def test_arrivals_in_order_of_their_number(spark, tmp_path, monkeypatch):
    from strata.sources import landing
    monkeypatch.setattr(landing, "ARRIVAL_ROWS", 40)
    rows = spark.range(300).selectExpr("id AS event_id", "cast(id % 3 AS int) AS file")
    dest = str(tmp_path / "landed")
    assert landing.land_in_order(rows, dest, "file", 3, 300) == 3                  # 100 rows of an arrival are 3 files
    files = sorted((f for f in (os.path.join(d, n) for d, _, names in os.walk(dest) for n in names) if f.endswith(".parquet")), key=os.path.getmtime)
    assert len(files) == 9
    of = [{r["event_id"] % 3 for r in spark.read.parquet(f).collect()} for f in files]
    assert of == [{0}] * 3 + [{1}] * 3 + [{2}] * 3
    assert spark.read.parquet(dest).select("event_id").distinct().count() == 300
