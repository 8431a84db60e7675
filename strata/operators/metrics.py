"""Business metrics over the gold table: conversion and funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conversion_by(gold: DataFrame, dims, month_col: str | None = None,
                  flag: str = "has_transaction") -> DataFrame:
    """(dims..., [month], sessions, purchases, conversion_rate_pct)."""
    keys = [F.col(d) for d in dims]
    if month_col:
        keys.append(F.date_format(month_col, "yyyy-MM").alias("month"))
    return gold.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.col(flag)).alias("purchases"),
    ).withColumn("conversion_rate_pct", F.col("purchases") * 100.0 / F.col("sessions"))


def funnel_reached(path, steps) -> F.Column:
    """Number of funnel steps a session reached, in order: each step must
    occur after the previous one (earliest match, a single pass over the
    ordered path, JVM-side)."""
    arr = F.array(*[F.lit(s) for s in steps])
    n = len(steps)
    return F.aggregate(
        path, F.lit(0),
        lambda acc, x: F.when((acc < n) & (x == F.element_at(arr, acc + 1)), acc + 1).otherwise(acc))


def funnel_from_paths(sessions: DataFrame, steps, path_col: str = "event_types") -> DataFrame:
    """(step, event_type, sessions) from per-session ordered paths, e.g. the
    gold table's ``event_types``: one aggregate, no extra shuffle."""
    reached = funnel_reached(F.col(path_col), steps)
    row = sessions.select(reached.alias("_k")).agg(
        *[F.count_if(F.col("_k") >= i + 1).alias(f"_s{i}") for i in range(len(steps))])
    items = [F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("event_type"),
                      F.col(f"_s{i}").alias("sessions")) for i, s in enumerate(steps)]
    return row.select(F.explode(F.array(*items)).alias("_r")).select("_r.*")


def funnel(events: DataFrame, steps, keys, type_col: str, ts_col: str) -> DataFrame:
    """(step, event_type, sessions): sessions reaching each step in order,
    each step strictly after the previous one (earliest match).

    Computed step by step with bounded state: the earliest time of step 1
    per session (partial aggregate), then for each next step the events of
    that type joined to the previous step's time (one row per session, so a
    hot session only makes the event side skewed, which AQE splits) and
    reduced to the earliest later time. No per-session list is built.
    """
    keys = list(keys)
    reached = (events.filter(F.col(type_col) == steps[0])
               .groupBy(*keys).agg(F.min(ts_col).alias("_t")))
    counts = [reached.agg(F.count(F.lit(1)).alias("sessions")).select(
        F.lit(1).alias("step"), F.lit(steps[0]).alias("event_type"), "sessions")]
    for i, step in enumerate(steps[1:], start=2):
        nxt = (events.filter(F.col(type_col) == step).select(*keys, F.col(ts_col).alias("_ts"))
               .join(reached, keys, "inner")
               .filter(F.col("_ts") > F.col("_t"))
               .groupBy(*keys).agg(F.min("_ts").alias("_t")))
        counts.append(nxt.agg(F.count(F.lit(1)).alias("sessions")).select(
            F.lit(i).alias("step"), F.lit(step).alias("event_type"), "sessions"))
        reached = nxt
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
