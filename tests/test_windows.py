"""Window operators (sweep and prefix sums) against a brute-force single-partition
window on a fixture where one key holds most of the rows."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.windows import DAY, HOUR, prefix, running, trailing


def _fixture(spark, n=600, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = 0 if i % 3 else rnd.randint(1, 5)            # user 0 holds two thirds of the rows
        ts = base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400))
        if i % 17 == 0 and rows:
            ts = rows[-1][2]                                 # peers with equal time
        rows.append((i, user, ts, rnd.randint(1, 5000)))
    return spark.createDataFrame(rows, "id long, user long, ts timestamp, cents long")


def test_trailing_equals_range_window(spark):
    df = _fixture(spark)
    frames = {"s24": (DAY, "sum", F.col("cents")), "c1": (HOUR, "count", F.col("id")),
              "d24": (DAY, "distinct", F.col("cents") % 7)}
    got = trailing(df, "user", "ts", frames, bucket_seconds=6 * HOUR).select("id", "s24", "c1", "d24")
    w = Window.partitionBy("user").orderBy(F.unix_micros("ts"))
    exp = df.select("id",
                    F.sum("cents").over(w.rangeBetween(-DAY * 10**6, 0)).alias("s24"),
                    F.count("id").over(w.rangeBetween(-HOUR * 10**6, 0)).alias("c1"),
                    F.size(F.collect_set(F.col("cents") % 7).over(w.rangeBetween(-DAY * 10**6, 0))).alias("d24"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_running_and_prefix_equal_rows_window(spark):
    df = _fixture(spark)
    got = running(df, "user", "ts", "id", {"cum": F.col("cents")}, bucket_seconds=HOUR * 7)
    w = Window.partitionBy("user").orderBy("ts", "id")
    exp = df.select("id", F.sum("cents").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                    F.count("id").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_count"))
    assert sorted(got.select("id", "cum", "running_count").collect()) == sorted(exp.collect())

    got_max = prefix(df, "user", F.col("id"), "id", {"m": ("max", F.col("cents"))}, 50, include_current=False)
    w2 = Window.partitionBy("user").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    exp_max = df.select("id", F.max("cents").over(w2).alias("m"))
    assert sorted(got_max.select("id", "m").collect()) == sorted(exp_max.collect())


def test_trailing_targets_nulls_and_small_buckets(spark):
    """Only target rows are output; NULL values feed no frame; a sum over a
    frame without values is NULL; buckets narrower than the frame."""
    df = _fixture(spark).withColumn("v", F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("cents")))
    frames = {"s": (2 * HOUR, "sum", F.col("v")), "n": (2 * HOUR, "count", F.col("v")),
              "d": (3 * HOUR, "distinct", F.col("v") % 3)}
    got = trailing(df, "user", "ts", frames, bucket_seconds=600, target=F.col("id") % 5 == 0).select(
        "id", "s", "n", "d")
    w = Window.partitionBy("user").orderBy(F.unix_micros("ts"))
    exp = df.select("id",
                    F.sum("v").over(w.rangeBetween(-2 * HOUR * 10**6, 0)).alias("s"),
                    F.count("v").over(w.rangeBetween(-2 * HOUR * 10**6, 0)).alias("n"),
                    F.size(F.collect_set(F.col("v") % 3).over(w.rangeBetween(-3 * HOUR * 10**6, 0))).alias("d"),
                    ).filter(F.col("id") % 5 == 0)
    assert sorted(got.collect()) == sorted(exp.collect())


def test_trailing_distinct_with_duplicate_rows(spark):
    """Repeated (key, value, time) rows: the distinct count is unchanged."""
    df = _fixture(spark)
    dup = df.unionByName(df.filter(F.col("id") % 3 == 0).withColumn("id", F.col("id") + 100_000))
    frames = {"d": (DAY, "distinct", F.col("cents") % 5), "n": (HOUR, "count", F.col("cents"))}
    got = trailing(dup, "user", "ts", frames, bucket_seconds=2 * HOUR).select("id", "d", "n")
    w = Window.partitionBy("user").orderBy(F.unix_micros("ts"))
    exp = dup.select("id", F.size(F.collect_set(F.col("cents") % 5).over(w.rangeBetween(-DAY * 10**6, 0))).alias("d"),
                     F.count("cents").over(w.rangeBetween(-HOUR * 10**6, 0)).alias("n"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_trailing_with_running_totals(spark):
    """Running totals carried by the sweep equal ROWS UNBOUNDED PRECEDING over
    the target rows in (ts, id) order; frames still see every row."""
    df = _fixture(spark)
    tgt = F.col("id") % 3 == 0
    got = trailing(df, "user", "ts", {"c1": (HOUR, "count", F.col("id"))}, bucket_seconds=3 * HOUR,
                   target=tgt, running={"cum": F.col("cents"), "k": F.lit(1).cast("long")}, tiebreak="id")
    w = Window.partitionBy("user").orderBy(F.unix_micros("ts"))
    frames = df.select("id", F.count("id").over(w.rangeBetween(-HOUR * 10**6, 0)).alias("c1"))
    wr = Window.partitionBy("user").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    run = df.filter(tgt).select("id", F.sum("cents").over(wr).alias("cum"), F.count("id").over(wr).alias("k"))
    exp = frames.join(run, "id")
    assert sorted(got.select("id", "c1", "cum", "k").collect()) == sorted(exp.select("id", "c1", "cum", "k").collect())


def test_rows_without_time_or_key_stay(spark):
    """A row without a time keeps its place with empty aggregates and adds
    nothing to others; rows without a key are one key."""
    import datetime as dt
    at = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [(1, "u", at(1), 1000), (2, "u", None, 500), (3, "u", at(2), 250), (4, None, at(3), 7), (5, None, at(4), 8), (6, None, None, 9)]
    df = spark.createDataFrame(rows, "id int, user string, ts timestamp, cents long")
    frames = {"s": (DAY, "sum", F.col("cents")), "n": (HOUR, "count", F.col("id")), "d": (DAY, "distinct", F.col("cents"))}
    got = {r["id"]: (r["s"], r["n"], r["d"]) for r in trailing(df, "user", "ts", frames).collect()}
    assert got == {1: (1000, 1, 1), 2: (None, 0, 0), 3: (1250, 2, 2), 4: (7, 1, 1), 5: (15, 2, 2), 6: (None, 0, 0)}
    got = {r["id"]: (r["cum"], r["running_count"]) for r in running(df, "user", "ts", "id", {"cum": F.col("cents")}).collect()}
    assert got == {1: (1000, 1), 2: (None, 0), 3: (1250, 2), 4: (7, 1), 5: (15, 2), 6: (None, 0)}


def test_features_keep_every_transaction(spark):
    import datetime as dt

    from strata.plans import features
    t = spark.createDataFrame([(1, "u", dt.datetime(2024, 1, 1), 10.0), (2, "u", None, 5.0), (3, None, dt.datetime(2024, 1, 2), 1.005),
                               (4, "u", dt.datetime(2024, 1, 3), 2.0)],
                              "transaction_id int, user_id string, transaction_timestamp timestamp, amount double")
    got = {r["transaction_id"]: r["lifetime_value"] for r in features.velocity(t).collect()}
    assert got == {1: 10.0, 2: None, 3: 1.01, 4: 12.0}               # cents as DECIMAL rounds them
    e = spark.createDataFrame([("s", "u", dt.datetime(2024, 1, 1), "view")], "session_id string, user_id string, event_timestamp timestamp, event_type string")
    assert features.behaviour(e, t).count() == 4
