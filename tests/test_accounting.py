"""The stream that keeps its late rows: side output, marks across restarts and
replays, counts that add up, and the operator's own drop counter."""

import datetime as dt
import shutil

from strata.streaming import accounting, jobs
from tests.test_stateful import E, _arrive, _at


def _stream(spark, tmp_path):
    return spark.readStream.schema(E).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def _split(spark, tmp_path, ck="ck"):
    out = str(tmp_path / "out")
    q = accounting.split_late(_stream(spark, tmp_path), "event_timestamp", 3600, out, str(tmp_path / ck), 86400)
    q.awaitTermination()
    assert q.exception() is None
    return out


def _ids(spark, out, kind, schema):
    return sorted(r["event_id"] for r in accounting.rows_of(spark, out, kind, schema).collect())


def test_late_rows_kept_and_counts_add_up(spark, tmp_path):
    src = str(tmp_path / "in")
    _arrive(spark, src, 0, [(1, 7, "a", _at(1, 10), 1.0), (2, 7, "b", None, 2.0), (3, 8, "c", _at(3, 2), 3.0)])
    # newest 3rd 02:00, mark 01:00: the 1st and 2nd are over, the 3rd is not
    _arrive(spark, src, 1, [(4, 7, "d", _at(2, 23), 1.0), (4, 7, "d", _at(2, 23), 1.0), (5, 7, "e", _at(3, 0), 1.0)])
    schema = _stream(spark, tmp_path).schema
    out = _split(spark, tmp_path)
    assert _ids(spark, out, "late", schema) == [4, 4]
    assert _ids(spark, out, "untimed", schema) == [2]
    assert _ids(spark, out, "on_time", schema) == [1, 3, 5]
    late = accounting.rows_of(spark, out, "late", schema).first()
    assert (late["mark"], late["behind_seconds"], late["batch"]) == (_at(3, 1), 7200.0, 1)
    # after a restart the mark goes on from the last batch; a late row never moves it back
    _arrive(spark, src, 2, [(6, 9, "f", _at(2, 1), 0.0), (7, 9, "g", _at(5), 0.0)])
    _split(spark, tmp_path)
    assert _ids(spark, out, "late", schema) == [4, 4, 6]
    sessions = jobs.session_stream(accounting.on_time_stream(spark, out, schema), delay="1 hour")
    q = (sessions.writeStream.format("parquet").option("path", str(tmp_path / "s")).option("checkpointLocation", str(tmp_path / "ck2"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = accounting.account(spark, out, spark.read.schema(sessions.schema).parquet(str(tmp_path / "s")), "total_events").first()
    assert got.asDict() == {"read": 8, "on_time": 4, "late": 3, "untimed": 1, "emitted": 3, "open": 1}


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    src = str(tmp_path / "in")
    _arrive(spark, src, 0, [(1, 7, "a", _at(3, 2), 1.0)])
    _arrive(spark, src, 1, [(2, 7, "b", _at(1, 2), 1.0), (3, 7, "c", _at(4, 2), 1.0)])
    schema = _stream(spark, tmp_path).schema
    out = _split(spark, tmp_path)
    shutil.copytree(str(tmp_path / "out"), str(tmp_path / "before"))
    _split(spark, tmp_path, "ck-lost")              # all batches again, as after a lost checkpoint
    for kind, ids in {"late": [2], "on_time": [1, 3], "untimed": []}.items():
        assert _ids(spark, out, kind, schema) == _ids(spark, str(tmp_path / "before"), kind, schema) == ids


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "total_events long")
    out = str(tmp_path / "nothing")
    assert accounting.rows_of(spark, out, "late", spark.createDataFrame([], E).schema).count() == 0
    assert accounting.account(spark, out, none, "total_events").first().asDict() == dict.fromkeys(
        ["read", "on_time", "late", "untimed", "emitted", "open"], 0)


def test_operator_drops_are_counted(spark, tmp_path):
    """Without the split, the session operator drops what is behind its mark."""
    src = str(tmp_path / "in")
    for k, day in enumerate((1, 9, 10, 11)):
        _arrive(spark, src, k, [(k, 7, "a", _at(day), 1.0)])
    _arrive(spark, src, 4, [(5, 7, "late", _at(2), 1.0)])
    counter = accounting.DropCounter()
    spark.streams.addListener(counter)
    try:
        q = (jobs.session_stream(_stream(spark, tmp_path), delay="1 hour").writeStream.format("parquet")
             .option("path", str(tmp_path / "s")).option("checkpointLocation", str(tmp_path / "ck"))
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        assert counter.dropped(q) == 1
    finally:
        spark.streams.removeListener(counter)
    starts = {r["session_start_time"] for r in spark.read.parquet(str(tmp_path / "s")).collect()}
    assert dt.datetime(2024, 1, 2) not in starts and _at(1) in starts
