"""Clustered tables: same rows, files of one size, lookups that skip."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.tables import layout

S = "event_id long, user_id string, session_id string, event_timestamp timestamp, _curve string"
T0 = dt.datetime(2024, 1, 1)


def _rows(n, users, hot=0.0, seed=5):
    rng, out = random.Random(seed), []
    for i in range(n):
        u = 0 if rng.random() < hot else rng.randrange(users)
        t = T0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 60))
        out.append((i, f"u{u}", f"u{u}_{t.date()}", t, "x"))
    return out


def test_morton_key_interleaves_bits(spark):
    rng = random.Random(1)
    pairs = [(0, 0), ((1 << 31) - 1, 0), (0, (1 << 31) - 1), ((1 << 31) - 1,) * 2] + [
        (rng.getrandbits(31), rng.getrandbits(31)) for _ in range(200)]
    got = spark.createDataFrame(pairs, "x long, y long").select("x", "y", layout.curve_key(F.col("x"), F.col("y")).alias("k")).collect()
    for x, y, k in got:
        assert k == sum(((x >> b & 1) << (2 * b + 1)) | ((y >> b & 1) << (2 * b)) for b in range(31))


def test_lookups_skip_most_row_groups(spark, tmp_table):
    rows = _rows(20_000, 400)
    df = spark.createDataFrame(rows, S)
    layout.write_clustered(df, tmp_table, "user_id", "event_timestamp", ["session_id"], rows_per_file=1_250, rows_per_group=250)
    t = spark.read.parquet(tmp_table)
    assert sorted(map(tuple, t.collect())) == sorted(rows)
    _, user, session, at, _ = rows[77]
    for cond, share in ((F.col("user_id") == user, 0.25), (F.col("session_id") == session, 0.05),
                        (F.col("event_timestamp").between(F.lit(at), F.lit(at + dt.timedelta(hours=12))), 0.5)):
        expected = df.filter(cond).count()
        q = t.filter(cond)
        assert q.count() == expected > 0
        assert expected <= layout.scanned_rows(q) <= share * len(rows)
    spark.createDataFrame(rows, S).repartition(16).write.parquet(tmp_table + "_plain")
    plain = spark.read.parquet(tmp_table + "_plain")
    assert layout.scanned_rows(plain.filter(F.col("user_id") == user)) > 0.9 * len(rows)      # what it saves


def test_hot_user_and_hot_instant_are_cut(spark, tmp_table):
    rows = _rows(6_000, 50, hot=0.5) + [(10_000 + i, "one", "one", T0, "x") for i in range(6_000)]
    layout.write_clustered(spark.createDataFrame(rows, S), tmp_table, "user_id", "event_timestamp", rows_per_file=1_000)
    sizes = [r["rows"] for r in layout.per_file_spans(spark, tmp_table, "event_timestamp").collect()]
    assert sum(sizes) == 12_000 and len(sizes) >= 10 and max(sizes) < 2_500


def test_nulls_ties_empty_and_reclustering(spark, tmp_table):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "u", "s", T0, "c"), (2, "u", "s", T0, "c")]
    read = lambda: sorted(map(tuple, spark.read.parquet(tmp_table).collect()), key=repr)
    layout.write_clustered(spark.createDataFrame(rows, S), tmp_table, "user_id", "event_timestamp")
    assert read() == sorted(rows, key=repr)
    more = (3, "v", "s", T0, "d")
    spark.createDataFrame([more], S).write.mode("append").parquet(tmp_table)
    layout.write_clustered(spark.read.parquet(tmp_table), tmp_table, "user_id", "event_timestamp")        # reads itself
    assert read() == sorted([*rows, more], key=repr)
    bad = spark.range(5).select(F.col("id").alias("event_id"), F.raise_error(F.lit("lost executor")).cast("string").alias("user_id"),
                                F.lit("s").alias("session_id"), F.lit(T0).alias("event_timestamp"), F.lit("x").alias("_curve"))
    with pytest.raises(Exception, match="lost executor"):
        layout.write_clustered(bad, tmp_table, "user_id", "event_timestamp")
    assert read() == sorted([*rows, more], key=repr)
    layout.write_clustered(spark.createDataFrame([], S), tmp_table, "user_id", "event_timestamp")
    assert read() == [] and spark.read.parquet(tmp_table).columns == ["event_id", "user_id", "session_id", "event_timestamp", "_curve"]


def test_timestamps_are_written_with_statistics(spark, tmp_table):
    name = "spark.sql.parquet.outputTimestampType"
    was = spark.conf.get(name)
    spark.conf.set(name, "INT96")
    try:
        layout.write_clustered(spark.createDataFrame(_rows(2_000, 20), S), tmp_table, "user_id", "event_timestamp",
                               rows_per_file=500, rows_per_group=125)
        assert spark.conf.get(name) == "INT96"
    finally:
        spark.conf.set(name, was)
    q = spark.read.parquet(tmp_table).filter(F.col("event_timestamp") > F.lit(T0 + dt.timedelta(days=59)))
    assert layout.scanned_rows(q) < 1_000
