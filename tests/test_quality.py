import pytest
from pyspark.sql import functions as F

from strata.operators import quality as dq


def test_check_nulls_one_pass_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None), (4, "y")], "a long, b string")
    got = {r["column"]: (r["null_count"], r["null_percentage"]) for r in dq.check_nulls(df, ["a", "b"]).collect()}
    assert got == {"a": (1, 25.0), "b": (2, 50.0)}
    empty = {r["column"]: r["null_percentage"] for r in dq.check_nulls(df.limit(0), ["a"]).collect()}
    assert empty == {"a": 0.0}


def test_check_duplicates_counts_null_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    r = dq.check_duplicates(df, ["k"]).first()
    assert (r["total_rows"], r["distinct_keys"], r["duplicates"]) == (5, 3, 2)


def test_rules_and_fail_fast(spark):
    df = spark.createDataFrame([(1, "view", 5, 1), (1, "oops", -1, 9), (None, "view", 0, 2)],
                               "id long, t string, dur long, u long")
    parent = spark.createDataFrame([(1,), (2,)], "u long")
    rules = [dq.is_unique("id"), dq.is_complete("id"), dq.values_in("t", ["view"]),
             dq.min_value("dur", 0), dq.column_relation("dur_small", "dur", F.col("dur") < 10),
             dq.referential("u", parent, "u")]
    res = {r["rule"]: r["violations"] for r in dq.run_rules(df, rules).collect()}
    assert res == {"is_unique": 1, "is_complete": 1, "values_in": 1, "min_value": 1,
                   "dur_small": 0, "referential": 1}
    with pytest.raises(dq.QualityError):
        dq.fail_fast(dq.run_rules(df, rules))
    assert dq.fail_fast(dq.run_rules(df, [rules[4]])).count() == 1


def test_validate_schema(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    assert dq.validate_schema(df, ["a", "c"]) == {"c"}
    assert dq.extra_columns(df, ["a"]) == {"b"}
    assert dq.validate_schema(df, T.StructType([T.StructField("a", T.IntegerType())])) == {"a"}


def test_corrupt_threshold_and_profile(spark):
    df = spark.createDataFrame([(None,), ("x",), ("y",)], "c string")
    r = df.agg(*dq.corrupt_threshold(F.count(F.lit(1)), F.count_if(F.col("c").isNull()), 0.2)).first()
    assert r["corrupt_count"] == 1 and r["alarm"] is True
    p = dq.column_profile(df, exact=True).first()
    assert (p["null_count"], p["distinct_count"], p["min_value"], p["max_value"]) == (1, 2, "x", "y")
