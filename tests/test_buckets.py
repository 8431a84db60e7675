"""Bucketed tables: merges and joins that don't move the table."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.tables import buckets, files

S = "session_id string, user_id string, n long, note string"
KEYS = ["session_id", "user_id"]


def _df(spark, rows):
    return spark.createDataFrame(rows, S)


def _name():
    return f"t_{uuid.uuid4().hex}"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _base(n=40):
    return [(f"s{i}", f"u{i % 5}", i, "old") for i in range(n)]


def test_merge_keeps_the_table_in_its_buckets(spark, tmp_table):
    name = _name()
    base = [*_base(), (None, "u", 1, "null key"), ("s0", "u0", 99, "twin")]
    t = buckets.write_bucketed(_df(spark, base), name, tmp_table, KEYS, 4)
    assert _rows(t) == sorted(base, key=repr)
    load = [("s3", "u3", 300, "new"), ("x", "y", 1, "new"), (None, "u", 2, "null again")]
    gone = _df(spark, [("s4", "u4", 0, ""), ("nobody", "u", 0, "")])
    plan = buckets.merged(t, _df(spark, load), KEYS, 4, gone)
    assert buckets.exchanges_of_tables(plan, name) == []
    for _ in range(2):                                                   # a load may come again; null keys are inserted
        t = buckets.merge_bucketed(spark, name, tmp_table, _df(spark, load), KEYS, 4, gone)
    expected = [r for r in base if r[:2] not in (("s3", "u3"), ("s4", "u4"))] + load + [load[2]]
    assert _rows(t) == sorted(expected, key=repr) == _rows(buckets.attach(spark, _name(), tmp_table, KEYS, 4))
    twice = _df(spark, [("s5", "u0", 1, "a"), ("s5", "u0", 2, "b")])
    with pytest.raises(ValueError, match="more than one"):
        buckets.merge_bucketed(spark, name, tmp_table, twice, KEYS, 4)
    assert _rows(buckets.attach(spark, name, tmp_table, KEYS, 4)) == sorted(expected, key=repr)


def test_repeated_merges_place_every_row_in_its_bucket(spark, tmp_table):
    name, held = _name(), {r[:2]: r for r in _base()}
    buckets.write_bucketed(_df(spark, _base()), name, tmp_table, KEYS, 4)
    for k in range(3):
        load = [(f"s{i}", f"u{i % 5}", 1000 * k + i, f"load {k}") for i in range(k * 7, k * 7 + 20)]
        held |= {r[:2]: r for r in load}
        t = buckets.merge_bucketed(spark, name, tmp_table, _df(spark, load), KEYS, 4)
    assert _rows(t) == sorted(held.values(), key=repr)
    wrong = t.withColumn("f", F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c", 1).cast("int")).filter(
        F.col("f") != F.pmod(F.hash(*KEYS), F.lit(4)))
    assert wrong.count() == 0
    other = buckets.write_bucketed(_df(spark, _base(20)), _name(), tmp_table + "_other", KEYS, 4)
    joined = t.join(other.hint("shuffle_merge"), KEYS)
    plan = joined._jdf.queryExecution().toString()
    assert joined.count() == 20 and "Exchange" not in plan
    plain = t.join(spark.read.parquet(tmp_table + "_other").hint("shuffle_merge"), KEYS)          # what it saves
    assert "Exchange" in plain._jdf.queryExecution().toString()


def test_failure_keeps_the_table(spark, tmp_table):
    name = _name()
    buckets.write_bucketed(_df(spark, _base(6)), name, tmp_table, KEYS, 2)
    bad = _df(spark, _base(6)).withColumn("note", F.raise_error(F.lit("lost executor")).cast("string"))
    for call in (lambda: buckets.write_bucketed(bad, name, tmp_table, KEYS, 2),
                 lambda: buckets.merge_bucketed(spark, name, tmp_table, bad, KEYS, 2)):
        with pytest.raises(Exception, match="lost executor"):
            call()
    assert _rows(buckets.attach(spark, name, tmp_table, KEYS, 2)) == sorted(_base(6), key=repr)
    parent = tmp_table.rpartition("/")[0]
    assert not [n for n in files.folders(spark, parent) if files.NEW in n or files.OLD in n]


def test_hot_keys_are_refused(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    with pytest.raises(buckets.UnevenBucketsError, match="one key"):
        buckets.check_balance(hot, ["k"], 64, least_rows=100)
    buckets.check_balance(hot, ["k"], 64)                               # too few rows to matter
    buckets.check_balance(hot.filter("k != 'hot'"), ["k"], 64, least_rows=100)
    buckets.check_balance(hot.limit(0), ["k"], 64)


def test_empty_table_and_load(spark, tmp_table):
    name = _name()
    buckets.write_bucketed(_df(spark, []), name, tmp_table, KEYS, 2)
    assert buckets.merge_bucketed(spark, name, tmp_table, _df(spark, []), KEYS, 2).count() == 0
    assert _rows(buckets.merge_bucketed(spark, name, tmp_table, _df(spark, _base(3)), KEYS, 2)) == sorted(_base(3), key=repr)
