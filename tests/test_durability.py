"""No table is lost when a job fails, no row is dropped by marks or streams,
and a small load reads only the partitions its keys can be in."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from strata.sources import marks
from strata.tables import files, key_index, writes

S = "id long, v string, d date"
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(12)]


def _rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("id", "v", "d").collect()), key=repr)


def _failing(spark, schema=S):
    """A frame whose job fails while it is written."""
    cols = [F.lit(1).cast(f.dataType).alias(f.name) if f.name == "id" else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.createDataFrame([], schema).schema.fields]
    return spark.range(50).select(F.when(F.col("id") > 40, F.raise_error(F.lit("lost executor"))).cast("string").alias("v"), *[
        c for c in cols if "AS v" not in str(c)]).select(*spark.createDataFrame([], schema).columns)


def _left(path):
    return [f for f in glob.glob(f"{os.path.dirname(path)}/*") if "__old-" in f or "__new-" in f]


def test_failed_replace_keeps_the_table(spark, tmp_table):
    writes.write_replace(spark.createDataFrame([(1, "a", DAYS[0])], S), tmp_table)
    with pytest.raises(Exception, match="lost executor"):
        writes.write_replace(_failing(spark), tmp_table)
    assert _rows(spark, tmp_table) == [(1, "a", DAYS[0])] and not _left(tmp_table)
    writes.write_replace(spark.read.parquet(tmp_table).withColumn("v", F.lit("b")), tmp_table)      # may read itself
    assert _rows(spark, tmp_table) == [(1, "b", DAYS[0])] and not _left(tmp_table)


def test_failed_upserts_keep_the_tables(spark, tmp_path):
    flat, parts = str(tmp_path / "flat"), str(tmp_path / "parts")
    first = spark.createDataFrame([(1, "a", DAYS[0]), (2, "b", DAYS[1])], S)
    writes.upsert_table(spark, flat, first, ["id"])
    writes.upsert_partitions(spark, parts, first, ["id"], "d", indexed=True)
    for call in (lambda: writes.upsert_table(spark, flat, _failing(spark).limit(45).distinct(), ["id"]),
                 lambda: writes.upsert_partitions(spark, parts, _failing(spark), ["id"], "d", indexed=True)):
        with pytest.raises(Exception, match="lost executor"):
            call()
    assert _rows(spark, flat) == _rows(spark, parts) == [(1, "a", DAYS[0]), (2, "b", DAYS[1])]
    assert not _left(flat) and not _left(parts)


def test_publish_rolls_back_and_recover_finishes(spark, tmp_table, monkeypatch):
    put = lambda v: spark.createDataFrame([(k, v, d) for k, d in enumerate(DAYS[:3])], S)
    writes.upsert_partitions(spark, tmp_table, put("a"), ["id"], "d")
    real, n = files.rename, []

    def breaks(spark, source, target):
        n.append(1)
        if len(n) == 4:
            raise OSError("gone")
        real(spark, source, target)

    monkeypatch.setattr(files, "rename", breaks)
    with pytest.raises(OSError):
        writes.upsert_partitions(spark, tmp_table, put("b"), ["id"], "d")
    monkeypatch.setattr(files, "rename", real)
    assert {v for _, v, _ in _rows(spark, tmp_table)} == {"a"} and not _left(tmp_table)
    # a driver that died between the renames: whole table, and one partition
    os.rename(tmp_table, tmp_table + "__old-x")
    files.recover(spark, tmp_table)
    assert len(_rows(spark, tmp_table)) == 3 and not _left(tmp_table)
    os.makedirs(tmp_table + "__old-y")
    open(tmp_table + "__old-y/_partitions", "w").close()
    os.rename(f"{tmp_table}/d={DAYS[1]}", f"{tmp_table}__old-y/d={DAYS[1]}")
    files.recover(spark, tmp_table)
    assert len(_rows(spark, tmp_table)) == 3 and not _left(tmp_table)


# --- key index -------------------------------------------------------------

def _table(spark, path, n=6_000):
    rows = spark.range(n).select("id", F.lit("a").alias("v"), F.element_at(F.array(*map(F.lit, DAYS)), (F.col("id") % 12 + 1).cast("int")).alias("d"))
    rows = rows.unionByName(spark.createDataFrame([(None, "null key", DAYS[3]), (n + 5, "null day", None)], S))
    writes.upsert_partitions(spark, path, rows, ["id"], "d", indexed=True)


def test_small_load_reads_candidate_partitions_only(spark, tmp_table):
    """Data pages of all partitions that can't hold the key are destroyed;
    the load doesn't notice."""
    _table(spark, tmp_table)
    one = spark.createDataFrame([(17, "z", DAYS[0])], S)             # its older copy lives on day 17 % 12 = 5
    can = writes.may_hold(spark, tmp_table, one, ["id"])
    assert str(DAYS[5]) in can and len(can) <= 3
    before = [r for r in _rows(spark, tmp_table) if r[0] != 17]
    kept = {}
    for f in glob.glob(f"{tmp_table}/d=*/*.parquet"):
        value = os.path.basename(os.path.dirname(f))[2:]
        if value not in can | {str(DAYS[0])}:
            raw = open(f, "rb").read()
            kept[f] = raw
            size = int.from_bytes(raw[-8:-4], "little")              # the footer stays readable
            with open(f, "wb") as out:
                out.write(b"PAR1" + b"\xff" * (len(raw) - size - 12) + raw[-size - 8:])
    assert len(kept) >= 9
    with pytest.raises(Exception):
        spark.read.parquet(tmp_table).select("id").agg(F.sum("id")).collect()
    assert set(writes.upsert_partitions(spark, tmp_table, one, ["id"], "d", indexed=True)) == {str(DAYS[0]), str(DAYS[5])}
    for f, raw in kept.items():
        with open(f, "wb") as back:
            back.write(raw)
    assert _rows(spark, tmp_table) == sorted([*before, (17, "z", DAYS[0])], key=repr)


def test_index_gives_the_same_table_as_none(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    _table(spark, a, 700)
    writes.write_replace(spark.read.parquet(a), str(tmp_path / "copy"))
    writes.upsert_partitions(spark, b, spark.read.parquet(str(tmp_path / "copy")), ["id"], "d")
    for k in range(3):
        load = spark.createDataFrame([(i * (k + 3) % 900, f"load{k}", DAYS[(i + k) % 12]) for i in range(0, 40)]
                                     + [(None, "n", DAYS[k]), (705, "moved", DAYS[k])], S).dropDuplicates(["id"])
        gone = spark.createDataFrame([(i,) for i in range(500 + 10 * k, 505 + 10 * k)], "id long")
        touched = [writes.upsert_partitions(spark, p, load, ["id"], "d", remove=gone, indexed=p == a) for p in (a, b)]
        assert touched[0] == touched[1] and _rows(spark, a) == _rows(spark, b)


def test_partitions_written_by_others_count_as_candidates(spark, tmp_table):
    _table(spark, tmp_table, 600)
    absent = spark.createDataFrame([(10**9,)], "id long")
    assert writes.may_hold(spark, tmp_table, absent, ["id"]) <= {"__HIVE_DEFAULT_PARTITION__"} | {str(d) for d in DAYS}
    writes.write_partitioned(spark.createDataFrame([(10**9, "other", DAYS[7])], S), tmp_table, "d")     # behind the index's back
    assert str(DAYS[7]) in writes.may_hold(spark, tmp_table, absent, ["id"])
    writes.upsert_partitions(spark, tmp_table, spark.createDataFrame([(10**9, "mine", DAYS[2])], S), ["id"], "d", indexed=True)
    assert [r for r in _rows(spark, tmp_table) if r[0] == 10**9] == [(10**9, "mine", DAYS[2])]
    files.remove(spark, key_index.index_path(tmp_table))
    assert writes.may_hold(spark, tmp_table, absent, ["id"]) == set(writes.list_partitions(spark, tmp_table, "d"))


def test_index_misses_nothing_and_rarely_errs(spark, tmp_table):
    _table(spark, tmp_table, 30_000)
    keys = spark.range(0, 30_000, 97).select("id")
    assert len(writes.may_hold(spark, tmp_table, keys, ["id"])) >= 12
    wrong = sum(len(writes.may_hold(spark, tmp_table, spark.createDataFrame([(10**6 + k,)], "id long"), ["id"])) for k in range(6))
    assert wrong <= 6                                             # of 6 * 13


# --- marks -----------------------------------------------------------------

M = "id long, ts timestamp"


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def _loads(spark, mark, *sources, lookback="2 days"):
    taken = []
    for rows in sources:
        inc = marks.increment(spark, spark.createDataFrame(rows, M), mark, "id", "ts", lookback)
        taken.append(sorted([r["id"] for r in inc.collect()], key=repr))
        marks.advance(spark, inc, mark, "id", "ts", lookback)
    return taken


def test_null_times_and_late_rows_are_taken_once(spark, tmp_path):
    first = [(1, _at(9)), (2, _at(10)), (3, None), (None, _at(10))]
    second = [*first, (4, None), (5, _at(9, 5)), (6, _at(11)), (7, _at(8, 1)), (None, None)]
    third = [*second, (8, _at(9, 1)), (9, _at(2)), (10, _at(2)), (11, _at(9, 23))]
    mark = str(tmp_path / "mark")
    assert _loads(spark, mark, first, second, second, third, third) == [
        [1, 2, 3, None], [4, 5, 6, 7, None], [], [11, 8], []]
    late = marks.too_late(spark, spark.createDataFrame(third, M), mark, "ts").collect()
    assert [tuple(r) for r in late] == [(dt.date(2024, 1, 2), 2, 0, 2)]                    # counted, not silently dropped
    assert marks.too_late(spark, spark.createDataFrame(third, M), str(tmp_path / "none"), "ts").count() == 6


def test_only_rows_without_time(spark, tmp_path):
    assert _loads(spark, str(tmp_path / "m"), [(1, None)], [(1, None), (2, _at(3))], [(1, None), (2, _at(3)), (2, None)]) == [[1], [2], [2]]


def test_failed_mark_keeps_the_old_one(spark, tmp_path):
    mark = str(tmp_path / "mark")
    _loads(spark, mark, [(1, _at(1))])
    bad = spark.range(3).select("id", F.when(F.col("id") == 2, F.raise_error(F.lit("lost executor")).cast("timestamp")).otherwise(F.lit(_at(2))).alias("ts"))
    with pytest.raises(Exception, match="lost executor"):
        marks.advance(spark, bad, mark, "id", "ts")
    assert _loads(spark, mark, [(1, _at(1)), (2, _at(1))]) == [[2]]


# --- streams ---------------------------------------------------------------

def test_gold_stream_keeps_rejected_lines(spark, tmp_path):
    """Lines read = rows in silver + older copies + quarantined lines."""
    from strata.streaming import jobs
    from tests.test_streaming import TXS, USS, _line
    src = tmp_path / "landing"
    src.mkdir()
    good = [_line(1, "s1", 7, "view", "2024-01-02 10:00:00"), _line(2, "s1", 7, "click", "2024-01-02 10:05:00"),
            _line(2, "s1", 7, "click", "2024-01-02 10:05:01")]
    bad = ["{bad", "", _line(3, None, 7, "view", "2024-01-02 11:00:00"), _line(None, "s1", 7, "view", "2024-01-02 11:00:00")]
    (src / "a.json").write_text("\n".join(good[:2] + bad[:3]) + "\n")
    (src / "b.json").write_text("\n".join(good[2:] + bad[3:]) + "\n")
    silver = str(tmp_path / "silver")
    tx, users = spark.createDataFrame([], TXS), spark.createDataFrame([], USS)
    for _ in range(2):                                   # a restart reads nothing again
        q = jobs.gold_upsert(jobs.json_line_stream(spark, str(src), max_files_per_trigger=1), silver, str(tmp_path / "gold"),
                             str(tmp_path / "ck"), tx, users)
        q.awaitTermination()
        assert q.exception() is None
    left = spark.read.text(silver + "_quarantine").groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in left} == {"malformed": 2, "null_key": 2}
    assert spark.read.parquet(silver).count() == 2       # and one older copy: 2 + 1 + 4 = 7 lines


def test_rejected_purchases(spark):
    from strata.sources.schemas import RAW_TRANSACTION
    from strata.streaming import jobs
    lines = spark.createDataFrame([(x,) for x in ("t1,s,u,1.5,USD,2024-01-01", "t2,s,u,-1,USD,2024-01-01", "t3,,u,2,USD,x", "t4,s,u,oops,USD,x", "", "t1,s,u,1.5,USD,2024-01-01")], "value string")
    clean = jobs.newest_purchases(RAW_TRANSACTION)
    reasons = sorted(r["reason"] for r in clean.rejected(lines).collect())
    assert clean(lines).count() == 1 and reasons == ["amount", "malformed", "malformed", "null_key"]


# --- history ---------------------------------------------------------------

def test_states_of_random_loads(spark, tmp_table):
    """Sets, removals, returns and re-runs against dictionaries."""
    import random

    from strata.tables import loads
    r = random.Random(6)
    states, state, keyless, old = {0: ({}, [])}, {}, [], []
    for load in range(1, 9):
        if load in (4, 7):
            to = load - 2
            loads.go_back(spark, tmp_table, ["id"], to, load)
            state, keyless = dict(states[to][0]), list(states[to][1])
        else:
            put = {k: f"v{load}.{k}" for k in r.sample(range(12), 4)}
            drop = [k for k in r.sample(range(14), 3) if k not in put]
            rows = [(k, v, DAYS[0]) for k, v in put.items()] + [(None, f"n{load}", DAYS[1])]
            if load == 5:                       # a run that is repeated with other rows
                loads.append_load(spark.createDataFrame([(99, "wrong", DAYS[0])], S), tmp_table, load)
            loads.append_load(spark.createDataFrame(rows, S), tmp_table, load,
                              removed=spark.createDataFrame([(k,) for k in drop], "id long"), keys=["id"])
            state = {k: v for k, v in {**state, **put}.items() if k not in drop}
            keyless = [*keyless, f"n{load}"]
        states[load] = (dict(state), list(keyless))
        old.append(load)
    for load in old:
        want = sorted([*states[load][0].items(), *((None, v) for v in states[load][1])], key=repr)
        assert sorted(map(tuple, loads.as_of(spark, tmp_table, ["id"], load).select("id", "v").collect()), key=repr) == want
    history = dict(map(tuple, loads.load_history(spark, tmp_table, ["id"]).collect()))
    assert history == {k: len(states[k][0]) + len(states[k][1]) for k in old}
    versions = loads.intervals(spark, tmp_table, ["id"]).collect()
    for load in old:
        valid = [(v["id"], v["v"]) for v in versions if v["valid_from"] <= load and (v["valid_to"] is None or load < v["valid_to"])]
        assert {k: v for k, v in valid if k is not None} == states[load][0]


def test_failed_load_keeps_history(spark, tmp_table):
    from strata.tables import loads
    loads.append_load(spark.createDataFrame([(1, "a", DAYS[0])], S), tmp_table, 1)
    with pytest.raises(Exception, match="lost executor"):
        loads.append_load(_failing(spark), tmp_table, 1)
    assert [r["v"] for r in loads.as_of(spark, tmp_table, ["id"]).collect()] == ["a"]


def _files(path):
    return {f"{d.rpartition('/')[2]}/{n}" for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_new_rows_are_added_to_a_partition_and_matched_rows_rewrite_theirs(spark, tmp_table, monkeypatch):
    schema = "id long, at long, v string, d string"
    up = lambda rows, **kw: writes.upsert_partitions(spark, tmp_table, spark.createDataFrame(rows, schema), ["id"], "d", "at", indexed=True, **kw)
    read = lambda: sorted(tuple(r[c] for c in ("id", "at", "v", "d")) for r in spark.read.parquet(tmp_table).collect() if r["id"] is not None)
    up([(1, 1, "a", "x"), (2, 5, "b", "x"), (3, 1, "c", "y"), (None, 1, "n", "x")])
    first = _files(tmp_table)
    # new rows for x and z; 3 moves from y to x; 2 is older than what is held
    assert up([(4, 1, "d", "x"), (5, 1, "e", "z")]) == ["x", "z"]
    assert first < _files(tmp_table)                               # nothing was written anew
    second = _files(tmp_table)
    assert up([(3, 2, "C", "z"), (6, 1, "f", "x")]) == ["x", "y", "z"]
    assert {f for f in second if f[:3] != "d=y"} < _files(tmp_table) and not [f for f in _files(tmp_table) if f[:3] == "d=y"]
    third = _files(tmp_table)
    up([(2, 4, "old", "z")])                                        # lost: its own partition gets nothing and keeps all
    assert {f for f in third if f[:3] == "d=z"} == {f for f in _files(tmp_table) if f[:3] == "d=z"}
    want = [(1, 1, "a", "x"), (2, 5, "b", "x"), (3, 2, "C", "z"), (4, 1, "d", "x"), (5, 1, "e", "z"), (6, 1, "f", "x")]
    assert read() == want
    assert spark.read.parquet(tmp_table).filter("id IS NULL").count() == 1

    before, rename, done = _files(tmp_table), files.rename, []
    def fails(spark, source, target):                               # the second file doesn't get to its place
        if target.endswith(".parquet"):
            if done:
                raise OSError("full")
            done.append(target)
        rename(spark, source, target)
    monkeypatch.setattr(files, "rename", fails)
    with pytest.raises(OSError):
        up([(7, 1, "g", "x"), (8, 1, "h", "z")])
    monkeypatch.undo()
    assert done and _files(tmp_table) == before and read() == want
    monkeypatch.setattr(writes, "CROWD", 1)                         # many small files are written as one
    up([(7, 1, "g", "x")])
    assert len([f for f in _files(tmp_table) if f[:3] == "d=x"]) == 1 and read() == [*want, (7, 1, "g", "x")]


def test_a_load_of_many_keys_is_not_looked_up(spark, tmp_table, monkeypatch):
    rows = spark.range(200).selectExpr("id", "cast(id % 4 AS string) AS d")
    writes.upsert_partitions(spark, tmp_table, rows, ["id"], "d", indexed=True)
    absent = spark.range(1000, 1040).select("id")
    assert len(writes.may_hold(spark, tmp_table, absent, ["id"])) < 4
    monkeypatch.setattr(key_index, "MANY", 10)
    assert writes.may_hold(spark, tmp_table, absent, ["id"]) == {"0", "1", "2", "3"}
