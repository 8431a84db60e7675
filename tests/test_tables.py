import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.tables import loads, writes

S = "id long, v string, ts timestamp, d date"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
T1, T2 = dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 2, 9)


def _rows(df):
    return sorted((tuple(r) for r in df.select("id", "v", "d").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_merge_upsert_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a", T1, D1), (2, "b", T1, D1), (None, "n", T1, D1)], S)
    upd = spark.createDataFrame([(2, "B", T2, D2), (3, "c", T2, D2), (None, "m", T2, D2)], S)
    once = writes.merge_upsert(target, upd, ["id"])
    keyed = upd.filter("id IS NOT NULL")
    assert _rows(writes.merge_upsert(once, keyed, ["id"])) == _rows(once)   # idempotent on keys
    # a NULL key never matches (SQL MERGE): such a row is inserted on every run
    assert writes.merge_upsert(once, upd, ["id"]).filter("id IS NULL").count() == 3
    assert _rows(once) == [(None, "m", D2), (None, "n", D1), (1, "a", D1), (2, "B", D2), (3, "c", D2)]


def test_merge_order_col_keeps_newer_target(spark):
    target = spark.createDataFrame([(1, "new", T2, D2)], S)
    upd = spark.createDataFrame([(1, "old", T1, D1)], S)
    assert _rows(writes.merge_upsert(target, upd, ["id"], order_col="ts")) == [(1, "new", D2)]


def test_merge_cardinality(spark):
    target = spark.createDataFrame([(1, "a", T1, D1)], S)
    upd = spark.createDataFrame([(1, "x", T1, D1), (1, "y", T1, D1), (2, "z", T1, D1), (2, "w", T1, D1)], S)
    bad = writes.merge_cardinality_violations(target, upd, ["id"]).collect()
    assert [(r["id"], r["source_rows"]) for r in bad] == [(1, 2)]
    with pytest.raises(writes.MergeCardinalityError):
        writes.check_merge_cardinality(target, upd, ["id"])


def test_upsert_moves_row_to_earlier_partition(spark, tmp_table):
    first = spark.createDataFrame([(1, "a", T2, D2), (2, "b", T1, D1)], S)
    writes.upsert_partitions(spark, tmp_table, first, ["id"], "d")
    late = spark.createDataFrame([(1, "a*", T1, D1)], S)     # late event: row 1 now belongs to D1
    touched = writes.upsert_partitions(spark, tmp_table, late, ["id"], "d")
    assert set(touched) == {str(D1), str(D2)}
    out = spark.read.parquet(tmp_table)
    assert _rows(out) == [(1, "a*", D1), (2, "b", D1)]
    import os
    assert not os.path.exists(f"{tmp_table}/d={D2}")          # emptied partition removed
    writes.upsert_partitions(spark, tmp_table, late, ["id"], "d")
    assert _rows(spark.read.parquet(tmp_table)) == [(1, "a*", D1), (2, "b", D1)]


def test_merge_keeps_duplicates_on_both_sides(spark):
    """Untouched duplicate target rows and duplicate new rows survive."""
    target = spark.createDataFrame([(1, "a", T1, D1), (1, "b", T1, D1), (2, "c", T1, D1)], S)
    upd = spark.createDataFrame([(9, "x", T2, D2), (9, "y", T2, D2), (2, "z", T2, D2)], S)
    want = [(1, "a", D1), (1, "b", D1), (2, "z", D2), (9, "x", D2), (9, "y", D2)]
    assert _rows(writes.merge_upsert(target, upd, ["id"])) == want
    assert _rows(writes.merge_upsert(target, upd, ["id"], order_col="ts")) == want


def test_upsert_same_on_first_and_later_loads(spark, tmp_path):
    """Duplicate keys of a first load survive a later load that does not
    mention them; a first load and a later one insert them alike."""
    new = spark.createDataFrame([(9, "x", T2, D2), (9, "y", T2, D2)], S)
    other = spark.createDataFrame([(5, "p", T2, D2), (6, "q", T2, D2), (6, "r", T2, D2)], S)
    results = []
    for order in ([new, other], [other, new]):
        path = str(tmp_path / f"t{len(results)}")
        for load in order:
            writes.upsert_partitions(spark, path, load, ["id"], "d")
        results.append(_rows(spark.read.parquet(path)))
    assert results[0] == results[1] == [(5, "p", D2), (6, "q", D2), (6, "r", D2), (9, "x", D2), (9, "y", D2)]


def test_upsert_removes_keys_and_skips_unchanged(spark, tmp_table):
    rows = [(1, "a", T1, D1), (2, "b", T1, D1), (3, "c", T2, D2)]
    writes.upsert_partitions(spark, tmp_table, spark.createDataFrame(rows, S), ["id"], "d")
    again = spark.createDataFrame([(1, "a", T2, D1), (3, "c", T2, D2)], S)       # only the ignored column differs
    assert writes.upsert_partitions(spark, tmp_table, again, ["id"], "d", ignore_changes_in=["ts"]) == []
    gone = spark.createDataFrame([(3,), (77,)], "id long")
    assert writes.upsert_partitions(spark, tmp_table, again.limit(0), ["id"], "d", remove=gone) == [str(D2)]
    assert _rows(spark.read.parquet(tmp_table)) == [(1, "a", D1), (2, "b", D1)]


def test_upsert_leaves_no_scratch_tables(spark, tmp_table):
    import os

    from strata.session import shared_dir
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    for _ in range(2):
        writes.upsert_partitions(spark, tmp_table, spark.createDataFrame([(1, "a", T1, D1)], S), ["id"], "d")
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before


def test_load_history(spark, tmp_table):
    loads.append_load(spark.createDataFrame([(1, "a", T1, D1), (4, "d", T1, D1), (None, "n", T1, D1)], S), tmp_table, 1)
    loads.append_load(spark.createDataFrame([(1, "b", T2, D2), (2, "c", T2, D2), (2, "c2", T2, D2)], S), tmp_table, 2)
    history = sorted(tuple(r) for r in loads.load_history(spark, tmp_table, ["id"]).collect())
    assert history == [(1, 3), (2, 5)]
    assert _rows(loads.as_of(spark, tmp_table, ["id"], 1)) == [(None, "n", D1), (1, "a", D1), (4, "d", D1)]
    assert loads.as_of(spark, tmp_table, ["id"]).count() == 5
    loads.append_load(spark.createDataFrame([(1, "b", T2, D2)], S), tmp_table, 2)      # a re-run replaces the load
    assert _rows(loads.as_of(spark, tmp_table, ["id"])) == [(None, "n", D1), (1, "b", D2), (4, "d", D1)]


def test_stored_high_water_mark(spark, tmp_path):
    """An empty increment keeps the mark; ties are taken exactly once."""
    from strata.sources import marks
    mark, schema = str(tmp_path / "mark"), "id long, ts timestamp"
    taken = []
    for rows in ([(1, T1), (2, T1)], [(1, T1), (2, T1)], [(1, T1), (2, T1), (3, T1), (4, T2)], [], [(4, T2), (5, T2)], [(4, T2), (5, T2)]):
        inc = marks.increment(spark, spark.createDataFrame(rows, schema), mark, "id", "ts")
        taken.append(sorted(r["id"] for r in inc.collect()))
        marks.advance(spark, inc, mark, "id", "ts")
    assert taken == [[1, 2], [], [3, 4], [], [5], []]


def test_blank_and_bad_lines_are_corrupt(spark):
    from strata.sources.readers import parse_csv_lines, parse_json_lines
    from strata.sources.schemas import CORRUPT_COL, RAW_TRANSACTION
    lines = spark.createDataFrame([("",), ('{"event_id": "1"}',), ("{bad",), ("  ",)], "value string")
    got = [(r["event_id"], r[CORRUPT_COL]) for r in parse_json_lines(lines).collect()]
    assert got == [(None, ""), ("1", None), (None, "{bad"), (None, "  ")]
    csv = spark.createDataFrame([("t1,s,u,1.5,USD,x",), ("t2,s,u,oops,USD,x",), ("",), ("t3,s",)], "value string")
    got = parse_csv_lines(csv, "value", RAW_TRANSACTION, CORRUPT_COL).collect()
    assert [r["amount"] for r in got] == [1.5, None, None, None]
    assert [r[CORRUPT_COL] is not None for r in got] == [False, True, True, True]


def test_evolve_schema(spark):
    old = spark.createDataFrame([(1,)], "id long")
    new = spark.createDataFrame([(2, 5)], "id long, k long")
    out = sorted(tuple(r) for r in writes.evolve_schema(old, new).collect())
    assert out == [(1, None), (2, 5)]


def test_write_partitioned_splits_hot_partition(spark, tmp_table):
    import glob
    df = spark.range(20000).select(F.col("id"), (F.col("id") * 7).alias("x"),
                                   F.when(F.col("id") < 19000, F.lit(D1)).otherwise(F.lit(D2)).alias("d"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        writes.write_partitioned(df.repartition(4), tmp_table, "d")
    finally:
        spark.conf.set(key, old)
    assert len(glob.glob(f"{tmp_table}/d={D1}/*.parquet")) > 1        # hot value split over tasks
    assert spark.read.parquet(tmp_table).count() == 20000


def test_medallion_counts_and_rerun(spark, tmp_path):
    """The silver loads report their row counts; a re-run of the same input
    changes nothing and rewrites nothing; no scratch table is left."""
    from strata.plans.medallion import run_medallion
    from strata.sources import landing
    sf = "/root/testdata/sf0.001"
    lines = landing.event_json_lines(spark, sf), landing.transaction_csv_lines(spark, sf), \
        landing.user_csv_lines(spark, sf)
    base = str(tmp_path / "lake")
    res = run_medallion(spark, *lines, base)
    c = res.counts
    assert c["events_bronze"] == lines[0].count()
    assert 0 < c["events_clean"] < c["events_bronze"]
    assert c["transactions_clean"] == spark.read.parquet(res.paths["transactions_clean"]).count()
    assert c["users_dim"] == spark.read.parquet(res.paths["users_dim"]).count()
    gold_path = res.paths["user_session_analysis"]
    first = spark.read.parquet(gold_path).drop("processing_timestamp")
    first_rows = sorted(first.collect())
    assert c["gold_staged"] == len(first_rows)
    assert res.touched_dates == writes.list_partitions(spark, gold_path, "session_date")
    again = run_medallion(spark, *lines, base)
    assert again.touched_dates == []
    assert sorted(spark.read.parquet(gold_path).drop("processing_timestamp").collect()) == first_rows


def _event(eid, sid, uid, typ, ts):
    import json
    return json.dumps({"event_id": eid, "session_id": sid, "user_id": uid, "event_type": typ, "event_timestamp": ts,
                       "event_details": {"price": None}})


def test_second_load_merges(spark, tmp_path):
    """A later load adds to silver and gold, and replaces only what it holds;
    a failing rule or too many malformed lines stop it before silver."""
    from strata.operators.quality import QualityError
    from strata.plans.medallion import run_medallion
    text = lambda rows: spark.createDataFrame([(r,) for r in rows], "value string")
    base = str(tmp_path / "lake")
    run_medallion(spark, text([_event("e1", "s1", "u1", "view", "2024-01-01 10:00:00"), _event("e2", "s1", "u1", "purchase", "2024-01-01 10:05:00"),
                               _event("e4", "s4", "u2", "view", "2024-01-03 08:00:00"), "", "{bad"]),
                  text(["t1,s1,u1,9.50,USD,2024-01-01 10:05:00"]),
                  text(["u1,2023-01-01 00:00:00,ios,PE", "u2,2023-02-01 00:00:00,web,MX"]), base)
    res = run_medallion(spark, text([_event("e3", "s1", "u1", "late", "2024-01-01 09:00:00"),
                                     _event("e4", "s5", "u2", "view", "2024-01-03 09:00:00")]),     # e4 moves to another session
                        text(["t2,s5,u2,3.00,USD,2024-01-03 09:30:00"]), text(["u2,2023-03-01 00:00:00,tv,CL"]), base, load=2)
    ids = lambda name, col: sorted(r[0] for r in spark.read.parquet(res.paths[name]).select(col).collect())
    assert ids("events_clean", "event_id") == ["e1", "e2", "e3", "e4"]
    assert ids("transactions_clean", "transaction_id") == ["t1", "t2"] and ids("users_dim", "user_id") == ["u1", "u2"]
    gold = {r["session_id"]: r for r in spark.read.parquet(res.paths["user_session_analysis"]).collect()}
    assert set(gold) == {"s1", "s5"}                                  # s4 has no event left
    assert gold["s1"]["total_events"] == 3 and gold["s1"]["has_transaction"] and gold["s1"]["country"] == "PE"
    assert gold["s5"]["has_transaction"] and gold["s5"]["country"] == "CL"
    assert spark.read.text(res.paths["quarantine"]).count() == 2
    before = [spark.read.parquet(res.paths[n]).count() for n in ("events_clean", "user_session_analysis")]
    with pytest.raises(QualityError):
        run_medallion(spark, text([_event("e9", "s9", "u9", "odd", "2024-02-01 00:00:00")]), text([]), text([]), base,
                      allowed_event_types=["view"], load=3)
    with pytest.raises(QualityError):
        run_medallion(spark, text([_event("e9", "s9", "u9", "view", "2024-02-01 00:00:00"), "{bad"]), text([]), text([]), base,
                      max_corrupt_ratio=0.1, load=4)
    assert [spark.read.parquet(res.paths[n]).count() for n in ("events_clean", "user_session_analysis")] == before


def test_load_that_died_before_gold_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    from strata.plans import medallion
    from strata.sources.readers import table_exists
    from strata.streaming.jobs import newest_landed_events
    paths = medallion.table_paths(str(tmp_path / "lake"))
    rows = lambda *events: newest_landed_events(spark.createDataFrame([(x,) for x in events], "value string"))
    event = lambda eid, sid, ts: _event(int(eid), sid, 1, "view", ts)
    medallion.merge_load(spark, paths, events=rows(event(1, "s1", "2024-01-01 10:00:00"), event(2, "s1", "2024-01-01 11:00:00"),
                                                   event(3, "s3", "2024-01-02 08:00:00")))
    real = medallion.gold.user_session_analysis

    def die(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(medallion.gold, "user_session_analysis", die)
    moved = rows(event(2, "s2", "2024-01-01 12:00:00"), event(3, "s2", "2024-01-02 09:00:00"))
    with pytest.raises(RuntimeError):
        medallion.merge_load(spark, paths, events=moved)
    monkeypatch.setattr(medallion.gold, "user_session_analysis", real)
    medallion.merge_load(spark, paths, events=moved)
    got = {r["session_id"]: r["total_events"] for r in spark.read.parquet(paths["user_session_analysis"]).collect()}
    assert got == {"s1": 1, "s2": 2}                # s1 lost an event, s3 its only one
    assert not table_exists(spark, paths["user_session_analysis"] + "_pending")


def test_session_too_long_for_a_row_stops_the_load(spark, tmp_path):
    from strata.operators.quality import QualityError
    from strata.plans import medallion
    from strata.sources.readers import table_exists
    from strata.streaming.jobs import newest_landed_events
    import json
    lines = [json.dumps({"event_id": i, "session_id": "s", "user_id": 1, "event_type": "view", "event_timestamp": f"2024-01-01 10:00:0{i}"})
             for i in range(5)]
    events = newest_landed_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    paths = medallion.table_paths(str(tmp_path / "lake"))
    with pytest.raises(QualityError, match="total_events"):
        medallion.merge_load(spark, paths, events=events, max_session_events=4)
    assert not table_exists(spark, paths["user_session_analysis"])
    medallion.merge_load(spark, paths, events=events)
    assert spark.read.parquet(paths["user_session_analysis"]).first()["total_events"] == 5


def test_session_too_long_for_a_row_keeps_its_path_in_chunks(spark, tmp_path, monkeypatch):
    from strata.operators import paths as session_paths
    from strata.plans import medallion
    from strata.sources.readers import table_exists
    from strata.streaming.jobs import newest_landed_events
    monkeypatch.setattr(medallion, "MAX_SESSION_EVENTS", 4)
    monkeypatch.setattr(session_paths, "CHUNK", 2)
    events = lambda *ids, sid="long": newest_landed_events(spark.createDataFrame(
        [(_event(i, sid, 1, "click" if i % 2 else "view", f"2024-01-01 10:00:{i:02d}"),) for i in ids], "value string"))
    paths = medallion.table_paths(str(tmp_path / "lake"))
    table = lambda: spark.read.parquet(paths["user_session_analysis"])
    gold = lambda: {r["session_id"]: (r["total_events"], r["event_types"] is not None) for r in table().collect()}
    aside = paths["user_session_analysis"] + "_paths"
    chunks = lambda: spark.read.parquet(aside)
    medallion.merge_load(spark, paths, events=events(1, 2, 3).unionByName(events(30, sid="other")))
    assert gold() == {"long": (3, True), "other": (1, True)} and not table_exists(spark, aside)
    assert medallion.merge_load(spark, paths, events=events(4, 5)).counts["sessions_in_chunks"] == 1
    assert gold() == {"long": (5, False), "other": (1, True)}
    assert [(r["position"], r["event_type"]) for r in session_paths.path_positions(chunks()).orderBy("position").collect()] == [
        (1, "click"), (2, "view"), (3, "click"), (4, "view"), (5, "click")]
    funnel = session_paths.funnel_of_gold(table(), chunks(), ["view", "click"])
    assert {r["step"]: r["sessions"] for r in funnel.collect()} == {1: 2, 2: 1}
    assert spark.read.parquet(paths["events_clean"]).count() == 6
    medallion.merge_load(spark, paths, events=events(31, sid="other"))             # later loads go on
    assert gold() == {"long": (5, False), "other": (2, True)} and chunks().agg({"events": "sum"}).first()[0] == 5
    moved = newest_landed_events(spark.createDataFrame([(_event(5, "other", 1, "view", "2024-01-01 11:00:00"),)], "value string"))
    medallion.merge_load(spark, paths, events=moved)                              # short enough again
    assert gold() == {"long": (4, True), "other": (3, True)} and not writes.list_partitions(spark, aside, "part")
    medallion.merge_load(spark, paths, events=events(6))                           # and too long once more
    assert gold()["long"] == (5, False) and chunks().count() > 0
    assert not table_exists(spark, paths["user_session_analysis"] + "_pending")


def test_table_exists_paths(spark, tmp_table):
    from strata.sources.readers import table_exists
    assert not table_exists(spark, tmp_table)
    spark.range(3).write.parquet(tmp_table)
    assert table_exists(spark, tmp_table)
    assert not table_exists(spark, "strata_no_such_table")
