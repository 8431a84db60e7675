"""Chunked paths and step automata against plain Python, at chunk sizes and
fan-outs that cut every session in many places."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import metrics, paths
from strata.operators.sessions import session_aggregate

S = "event_id string, session_id string, user_id string, event_type string, event_timestamp timestamp"
STEPS = ["view", "click", "view", "buy"]                    # a repeated step, too
T0 = dt.datetime(2024, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame(rows, S)


def _random_rows(n, sessions, seed=3, hot=0.5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = 0 if rng.random() < hot else rng.randrange(sessions)
        rows.append((f"e{i:05d}", f"s{s}" if s != 3 else None, f"u{s}" if s != 4 else None,
                     rng.choice(["view", "click", "buy", "scroll", "scroll", None]),
                     T0 + dt.timedelta(seconds=rng.randrange(n)) if rng.random() < 0.95 else None))
    return rows + rows[:7]                                  # repeated rows


def _python(rows, steps):
    """Session -> ordered path; session -> [(step, type, position, time)]."""
    by = {}
    for e, s, u, v, t in rows:
        if t is not None:
            by.setdefault((s, u), []).append((t, e, v or "", v))
    path, reached = {}, {}
    for k, items in by.items():
        items.sort(key=lambda x: x[:3])
        path[k] = [(x[3], x[0]) for x in items]
        got = []
        for pos, (v, t) in enumerate(path[k], 1):
            if len(got) < len(steps) and v == steps[len(got)]:
                got.append((len(got) + 1, v, pos, t))
        reached[k] = got
    return path, reached


@pytest.mark.parametrize("chunk,fan", [(1, 2), (7, 3), (4096, 64)])
def test_paths_and_funnel_against_python(spark, tmp_path, monkeypatch, chunk, fan):
    monkeypatch.setattr(paths, "FAN", fan)
    rows = _random_rows(600, 9)
    path, reached = _python(rows, STEPS)
    at = str(tmp_path / "chunks")
    paths.path_chunks(_events(spark, rows), chunk=chunk).write.parquet(at)
    chunks = spark.read.parquet(at)
    assert chunks.agg(F.max("events")).first()[0] <= chunk
    got = {}
    for r in paths.path_positions(chunks).orderBy("position").collect():
        got.setdefault((r["session_id"], r["user_id"]), []).append((r["event_type"], r["event_time"]))
        assert r["position"] == len(got[r["session_id"], r["user_id"]])
    assert got == path
    assert {(r[0], r[1]): r[2] for r in paths.steps_reached(chunks, STEPS).collect()} == {k: len(v) for k, v in reached.items()}
    funnel = [tuple(r) for r in paths.funnel_by_chunks(chunks, STEPS).orderBy("step").collect()]
    assert funnel == [(i + 1, s, sum(len(v) > i for v in reached.values())) for i, s in enumerate(STEPS)]
    gold = session_aggregate(_events(spark, rows).fillna("-", ["session_id", "user_id"]))
    assert funnel == [tuple(r) for r in metrics.funnel_from_paths(gold, STEPS).orderBy("step").collect()]
    times = paths.write_step_times(chunks, STEPS, str(tmp_path / "times")).collect()
    assert sorted(map(repr, [((r[0], r[1]), *tuple(r)[2:]) for r in times])) == sorted(
        map(repr, [(k, *x) for k, v in reached.items() for x in v]))


def test_hot_session_is_packed_by_many_tasks(spark):
    """One session with all rows: its chunks come from several range partitions."""
    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("event_id"), F.lit("s").alias("session_id"), F.lit("u").alias("user_id"),
        F.lit("view").alias("event_type"), F.timestamp_seconds(F.col("id")).alias("event_timestamp"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunks = paths.path_chunks(rows, chunk=1000).select("chunk_at", "events").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tasks = {}
    for at, n in chunks:
        tasks[at >> 33] = tasks.get(at >> 33, 0) + n
    assert sum(tasks.values()) == 20_000 and len(tasks) >= 6 and max(tasks.values()) < 8_000


def test_empty_paths(spark, tmp_path):
    chunks = paths.path_chunks(_events(spark, [("e", "s", "u", "view", None)]))
    assert chunks.count() == 0 and paths.path_positions(chunks).count() == 0
    assert [r["sessions"] for r in paths.funnel_by_chunks(chunks, ["a", "b"]).collect()] == [0, 0]
    assert paths.write_step_times(chunks, ["a"], str(tmp_path / "t")).count() == 0
    with pytest.raises(ValueError, match="step"):
        paths.steps_reached(chunks, [])


def test_replace_paths_touches_only_their_folders(spark, tmp_path):
    at = str(tmp_path / "paths")
    rows = lambda s, n: [(f"{s}{i}", s, "u", "view", T0 + dt.timedelta(seconds=i)) for i in range(n)]
    keys = lambda *s: spark.createDataFrame([(x, "u") for x in s], "session_id string, user_id string")
    sizes = lambda: {r[0]: r[1] for r in spark.read.parquet(at).groupBy("session_id").agg(F.sum("events")).collect()}
    names = [f"s{i}" for i in range(12)]
    paths.replace_paths(spark, at, paths.path_chunks(_events(spark, [r for s in names for r in rows(s, 5)]), chunk=2), keys(*names))
    before = set(spark.read.parquet(at).inputFiles())
    paths.replace_paths(spark, at, paths.path_chunks(_events(spark, rows("s3", 9)), chunk=2), keys("s3", "s4"))
    assert sizes() == {s: 9 if s == "s3" else 5 for s in names if s != "s4"}
    assert len(before - set(spark.read.parquet(at).inputFiles())) <= 2          # the folders of s3 and s4
    paths.replace_paths(spark, at, paths.path_chunks(_events(spark, [])), keys("nobody"))
    assert len(sizes()) == 11
