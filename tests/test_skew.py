"""Hot keys (one session / user holding most rows) with AQE forced to split
skewed partitions: results must equal the plain formulation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.joins import left_join_fanout
from strata.operators.sessions import session_aggregate
from strata.plans import gold

SKEW = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _events(spark, n=3000):
    base = dt.datetime(2024, 1, 1)
    e = spark.range(n).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 != 0, F.lit("s_hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string")))
        .alias("session_id"),
        F.when(F.col("id") % 3 != 0, F.lit("u_hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string")))
        .alias("user_id"),
        F.element_at(F.array(F.lit("view"), F.lit("click"), F.lit("purchase")), (F.col("id") % 3 + 1).cast("int"))
        .alias("event_type"),
        (F.lit(base) + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("event_timestamp"))
    return e


def test_fanout_join_with_hot_session(skewed):
    e = _events(skewed)
    sessions = session_aggregate(e, with_path=False)
    # every event doubles as a purchase: the hot session has 2000 of them
    tx = e.select("session_id", "user_id", F.col("event_id").alias("transaction_id"))
    got = left_join_fanout(sessions, tx, ["session_id", "user_id"])
    exp = sessions.join(tx, ["session_id", "user_id"], "left")
    cols = ["session_id", "user_id", "total_events", "transaction_id"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())


def test_gold_with_hot_user(skewed):
    e = _events(skewed)
    tx = e.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("transaction_id"), "session_id", "user_id",
        F.lit(10.0).alias("amount"), F.lit("USD").alias("currency"),
        F.col("event_timestamp").alias("transaction_timestamp"))
    users = e.select("user_id").distinct().select(
        "user_id", F.lit(dt.date(2023, 1, 1)).alias("signup_date"),
        F.lit("Web").alias("device_type"), F.lit("PE").alias("country"))
    g = gold.user_session_analysis(e, tx, users, stamp=False)
    rows = {r["session_id"]: r for r in g.collect()}
    hot = rows["s_hot"]
    assert hot["total_events"] == 2000 and hot["has_transaction"]
    assert hot["first_event_type"] == "click" and hot["country"] == "PE"
    assert len(hot["event_types"]) == 2000
    assert len(rows) == 51


def test_broadcast_only_under_summed_bounds(spark):
    """A dimension is broadcast only when the row counts of all its bounds
    together stay under the limit."""
    from strata.operators.joins import broadcast_if_small
    dim = spark.range(10).withColumnRenamed("id", "k")
    a, b = spark.range(60), spark.range(50)

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(broadcast_if_small(dim, [a, b], max_rows=110))
    assert not hinted(broadcast_if_small(dim, [a, b], max_rows=100))
    assert not hinted(broadcast_if_small(dim, a, max_rows=10, max_bytes=10**9))


def test_trailing_and_running_under_forced_skew_splits(skewed):
    """The sweep's prefix sums (window per (key, bucket) + join of bucket
    totals) stay exact when AQE splits the hot key's partitions."""
    import random

    from pyspark.sql import Window

    from strata.operators.windows import HOUR, running, trailing
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, 0 if i % 4 else rnd.randint(1, 3), base + dt.timedelta(seconds=rnd.randint(0, 2 * 86400)),
             rnd.randint(1, 900)) for i in range(1500)]
    df = skewed.createDataFrame(rows, "id long, user long, ts timestamp, cents long")
    got = trailing(df, "user", "ts", {"s": (3 * HOUR, "sum", F.col("cents")),
                                      "d": (3 * HOUR, "distinct", F.col("cents") % 11)},
                   bucket_seconds=HOUR, running={"cum": F.col("cents")}, tiebreak="id")
    w = Window.partitionBy("user").orderBy(F.unix_micros("ts")).rangeBetween(-3 * HOUR * 10**6, 0)
    wr = Window.partitionBy("user").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("id", F.sum("cents").over(w).alias("s"),
                    F.size(F.collect_set(F.col("cents") % 11).over(w)).alias("d"),
                    F.sum("cents").over(wr).alias("cum"))
    assert sorted(got.select("id", "s", "d", "cum").collect()) == sorted(exp.collect())
    run = running(df, "user", "ts", "id", {"c": F.col("cents")}, bucket_seconds=HOUR)
    assert sorted(run.select("id", "c").collect()) == sorted(exp.select("id", F.col("cum").alias("c")).collect())
