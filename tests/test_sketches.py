"""Merged sketches against exact figures, planted drift, and open payloads."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as dq
from strata.operators import sketches as sk
from strata.sources import payloads

CUTS = {"x": [100.0, 300.0, 600.0], "kind": ["a", "b"]}


def _load(spark, start, n, shift=0):
    i = F.col("id")
    return spark.range(start, start + n).select(
        F.when(i % 50 != 0, (i * 7919 % 1000 + shift).cast("double")).alias("x"),
        (i % 777).alias("u"), F.when(i % 10 < 6, "a").when(i % 10 < 9, "b").when(i % 100 == 9, F.lit(None)).otherwise("z").alias("kind"),
        F.timestamp_seconds(i * 60).alias("at"), F.array(i).alias("ids"))


def _stored(spark, path, loads):
    for k, df in enumerate(loads):
        sk.load_sketches(df, k, bins=CUTS).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def test_merged_profile_equals_scan(spark, tmp_path):
    loads = [_load(spark, 0, 3000), _load(spark, 2000, 4000, 5), _load(spark, 0, 0)]      # they overlap; one is empty
    p = sk.profile(sk.merge_sketches(_stored(spark, str(tmp_path / "s"), loads)))
    whole = loads[0].unionByName(loads[1])
    exact = {r["column"]: r for r in dq.column_profile(whole, exact=True).collect()}
    got = {r["column"]: r for r in p.collect()}
    assert set(got) == set(exact)
    for c, e in exact.items():
        g = got[c]
        assert (g["row_count"], g["null_count"], g["min_value"], g["max_value"]) == (7000, e["null_count"], e["min_value"], e["max_value"])
        assert abs(g["distinct_estimate"] - e["distinct_count"]) <= 0.05 * e["distinct_count"]
    xs = sorted(r["x"] for r in whole.filter("x IS NOT NULL").select("x").collect())
    for want, q in zip(sk.QUANTILES, got["x"]["quantiles"], strict=True):
        low, high = sum(v < q for v in xs) / len(xs), sum(v <= q for v in xs) / len(xs)
        assert low - 0.02 <= want <= high + 0.02
    assert got["kind"]["quantiles"] is None and got["at"]["quantiles"] is not None


def test_bins_are_exact_and_add_up(spark, tmp_path):
    loads = [_load(spark, 0, 500), _load(spark, 500, 700)]
    merged = sk.merge_sketches(_stored(spark, str(tmp_path / "s"), loads)).first()
    xs = [r["x"] for df in loads for r in df.select("x").collect()]
    want = [sum(v is not None and lo <= v < hi for v in xs) for lo, hi in
            zip([-1, 100, 300, 600], [100, 300, 600, 1e9], strict=True)] + [xs.count(None)]
    assert merged["x__bins"] == want and sum(want) == 1200
    kinds = [r["kind"] for df in loads for r in df.select("kind").collect()]
    assert merged["kind__bins"] == [kinds.count("a"), kinds.count("b"), kinds.count("z"), kinds.count(None)]


def test_planted_drift_stops_the_load(spark, tmp_path):
    loads = [_load(spark, 1000 * k, 1000) for k in range(5)]
    planted = _load(spark, 5000, 1000).withColumn("x", F.col("x") * 0.3)
    s = _stored(spark, str(tmp_path / "s"), [*loads, planted])
    ok = {r["column"]: r for r in sk.drift_gate(s, 4).collect()}
    assert set(ok) == {"x", "kind"} and not any(r["drifted"] for r in ok.values())
    with pytest.raises(dq.QualityError, match="load 5 drifted: x"):
        sk.drift_gate(s, 5)
    last = {r["column"]: r for r in sk.drift(s).filter("load = 5").collect()}
    assert last["kind"]["psi"] < 0.01 < 0.2 < last["x"]["psi"] and 0.2 < last["x"]["ks"] <= 1
    assert sk.drift(s).filter("load = 0").count() == 0


def test_empty_and_first_loads(spark, tmp_path):
    s = _stored(spark, str(tmp_path / "s"), [_load(spark, 0, 0), _load(spark, 0, 100), _load(spark, 0, 0)])
    d = {(r["load"], r["column"]): (r["psi"], r["ks"]) for r in sk.drift(s).collect()}
    assert d == {(k, c): (0.0, 0.0) for k in (1, 2) for c in ("x", "kind")}
    none = sk.profile(sk.merge_sketches(s.filter("load = 0"))).filter("column = 'x'").first()
    assert (none["row_count"], none["distinct_estimate"], none["min_value"], none["quantiles"]) == (0, 0, None, None)
    assert sk.drift_gate(s, 0).count() == 0
    with pytest.raises(ValueError, match="no binned column"):
        sk.drift(s.drop("x__bins", "kind__bins"))


def test_cuts_learnt_from_sketches_share_rows_out(spark, tmp_path):
    s = sk.merge_sketches(_stored(spark, str(tmp_path / "s"), [_load(spark, 0, 5000)]))
    cuts = sk.learn_cuts(s, "x", 4)
    assert len(cuts) == 3 and all(abs(c - w) < 30 for c, w in zip(cuts, (250, 500, 750), strict=True))


def test_many_loads_in_one_pass(spark):
    df = _load(spark, 0, 400).withColumn("day", F.to_date("at")).withColumn("at", F.lit(dt.datetime(2024, 1, 1)))
    rows = {r["load"]: (r["rows"], r["u__nulls"]) for r in sk.load_sketches(df, F.col("day"), ["u"]).collect()}
    assert rows == {dt.date(1970, 1, 1): (400, 0)}


# ------------------------------------------------------------ open payloads

LINES = ['{"price": 2.5, "k": 1, "new": "x"}', '{"price": "dear", "k": "one", "it\'s": [1]}', '{"k": null, "deep": {"a": {"b": 1}}}',
         '[1, 2]', '{"price": 1', '', None, '{}']


def _parsed(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(LINES)), "n int, line string")
    payloads.parse_open(df, "line", {"price": "double"}).write.parquet(str(tmp_path / "p"))
    return spark.read.parquet(str(tmp_path / "p"))


def test_unknown_keys_survive_the_table(spark, tmp_path):
    t = _parsed(spark, tmp_path)
    rows = {r["n"]: r for r in t.withColumn("unknown", payloads.unknown_keys(t, ["price"])).collect()}
    assert [rows[n]["is_corrupt"] for n in range(8)] == [False, False, False, True, True, True, True, False]
    assert [rows[n]["price"] for n in range(3)] == [2.5, None, None]
    assert [rows[n]["unknown"] for n in range(8)] == [["k", "new"], ["it's", "k"], ["deep", "k"], None, None, None, None, []]
    lifted = payloads.lift(payloads.lift(t, "k", "bigint"), "it's", "array<int>", "its").orderBy("n").collect()
    assert [r["k"] for r in lifted[:3]] == [1, None, None] and lifted[1]["its"] == [1]


def test_key_report_names_types(spark, tmp_path):
    report = payloads.key_report(_parsed(spark, tmp_path), ["price"])
    got = {(r["key"], r["type"]): r["rows"] for r in report.collect()}
    assert got == {("k", "BIGINT"): 1, ("k", "STRING"): 1, ("k", "VOID"): 1, ("new", "STRING"): 1, ("it's", "ARRAY"): 1, ("deep", "OBJECT"): 1}
    assert {r["key"] for r in payloads.settled_keys(report).collect()} == {"new", "it's", "deep"}


def test_keys_of_any_spelling_are_lifted(spark):
    keys = ["a.b", "it's", 'say "x"', """both ' and \"""", "ä[0]"]
    line = "{" + ", ".join(f"{json.dumps(k)}: {n}" for n, k in enumerate(keys)) + "}"
    t = payloads.parse_open(spark.createDataFrame([(line,)], "line string"), "line", {})
    for n, k in enumerate(keys):
        t = payloads.lift(t, k, "int", f"c{n}")
    assert [t.first()[f"c{n}"] for n in range(len(keys))] == list(range(len(keys)))
    assert t.select(payloads.unknown_keys(t, [])).first()[0] == sorted(keys)


def test_open_payload_clash_is_refused(spark):
    with pytest.raises(ValueError, match="already there: price"):
        payloads.parse_open(spark.createDataFrame([("{}", 1)], "line string, price int"), "line", {"price": "double"})
