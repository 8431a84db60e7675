"""Column profiles that merge: one small row of sketches per load, so that the
profile of a table, or of any set of its loads, needs no scan of its rows; and
the drift of a load against earlier ones, from the same rows.

Per column: rows, nulls, smallest and largest value (exact), a HyperLogLog
sketch (distinct values), a KLL sketch (quantiles; numbers, dates and times)
and counts by bin (exact): between given cuts for numbers, by value for text
columns with a given vocabulary. All merge by Spark's own aggregates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.operators.quality import QualityError

HLL_LG = 12            # relative error about 1.04 / sqrt(2^12) = 1.6 % (one sigma)
KLL_K = 400            # rank error about 0.7 %
QUANTILES = (0.05, 0.5, 0.95)
SMOOTHING = 0.5        # added to each bin's count in the population stability index


def _ordered(t: T.DataType) -> bool:
    return not isinstance(t, (T.MapType, T.ArrayType, T.StructType, T.VariantType))


def _number(c: Column, t: T.DataType) -> Column | None:
    """The value as a double for quantiles (times: microseconds), else None."""
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double") if isinstance(t, T.NumericType) else None


def _key(c: Column, t: T.DataType) -> Column:
    """The value as HyperLogLog takes it; equal values, equal keys."""
    if isinstance(t, T.IntegralType):
        return c.cast("bigint")
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("string") if _ordered(t) else F.to_json(c)


def _bin(c: Column, t: T.DataType, edges) -> Column:
    """Number of the bin: cuts at or below the value (numbers; NaN with the
    largest), or the place in the vocabulary (text; its length: any other).
    A null is in the last bin of all."""
    if isinstance(t, T.StringType):
        found = F.array_position(F.array(*[F.lit(v) for v in edges]), c).cast("int")
        return F.when(c.isNull(), len(edges) + 1).otherwise(F.when(found == 0, len(edges)).otherwise(found - 1))
    above = reduce(lambda a, b: a + b, [(c >= F.lit(e)).cast("int") for e in edges])
    return F.when(c.isNull(), len(edges) + 1).otherwise(above)


def load_sketches(df: DataFrame, load, cols=None, bins: dict | None = None) -> DataFrame:
    """One row for a load, to be appended to the table's sketches: ``load``,
    ``rows``, and for each column c ``c__nulls``, ``c__min``, ``c__max``,
    ``c__hll``, ``c__kll`` and ``c__bins`` (for columns in ``bins``: column ->
    ascending cuts, or vocabulary of a text column). One aggregate over the
    load, partial on the map side; a load without rows gives zeros and nulls.
    ``load`` is a literal, or a column to sketch many loads in one pass.
    """
    cols, bins = list(cols or df.columns), bins or {}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name in cols:
        c, t = F.col(name), df.schema[name].dataType
        aggs.append(F.count_if(c.isNull()).alias(f"{name}__nulls"))
        if _ordered(t):
            aggs += [F.min(c).alias(f"{name}__min"), F.max(c).alias(f"{name}__max")]
        aggs.append(F.hll_sketch_agg(_key(c, t), HLL_LG).alias(f"{name}__hll"))
        number = _number(c, t)
        if number is not None:
            aggs.append(F.kll_sketch_agg_double(F.when(~F.isnan(number), number), KLL_K).alias(f"{name}__kll"))
        if name in bins:
            b = _bin(c, t, bins[name])
            aggs.append(F.array(*[F.count_if(b == i) for i in range(len(bins[name]) + 2)]).alias(f"{name}__bins"))
    if isinstance(load, Column):
        return df.groupBy(load.alias("load")).agg(*aggs)
    return df.agg(*aggs).select(F.lit(load).alias("load"), "*")


def _columns(sketches: DataFrame) -> list[str]:
    return [c[:-len("__nulls")] for c in sketches.columns if c.endswith("__nulls")]


def merge_sketches(sketches: DataFrame, by: list | None = None) -> DataFrame:
    """Sketch rows of several loads as one row (per ``by``)."""
    aggs = [F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows")]
    for c in sketches.columns:
        kind = c.rsplit("__", 1)[-1] if "__" in c else ""
        if kind == "nulls":
            aggs.append(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c))
        elif kind in ("min", "max"):
            aggs.append(getattr(F, kind)(c).alias(c))
        elif kind == "hll":
            aggs.append(F.hll_union_agg(c).alias(c))
        elif kind == "kll":
            aggs.append(F.kll_merge_agg_double(c).alias(c))
        elif kind == "bins":
            aggs.append(_sum_arrays(sketches, c).alias(c))
    return sketches.groupBy(*(by or [])).agg(*aggs)


def _sum_arrays(sketches: DataFrame, c: str) -> Column:
    """Sum of arrays of one length, place by place: bounded by the bins."""
    return F.aggregate(F.collect_list(c), F.array().cast("array<bigint>"),
                       lambda a, x: F.when(F.size(a) == 0, x).otherwise(F.zip_with(a, x, lambda p, q: p + q)))


def profile(merged: DataFrame) -> DataFrame:
    """(column, row_count, null_count, distinct_estimate, min_value, max_value,
    quantiles) of one merged row; minimum and maximum as text, quantiles
    (``QUANTILES``) as doubles, times in microseconds; null for text."""
    items = []
    for c in _columns(merged):
        has = lambda k: f"{c}__{k}" in merged.columns  # noqa: B023, E731
        text = lambda k: F.col(f"{c}__{k}").cast("string") if has(k) else F.lit(None).cast("string")  # noqa: B023, E731
        q = F.lit(None).cast("array<double>")
        if has("kll"):
            ranks = F.array(*[F.lit(p) for p in QUANTILES])
            filled = F.kll_sketch_get_n_double(f"{c}__kll") > 0
            q = F.when(filled, F.kll_sketch_get_quantile_double(f"{c}__kll", ranks))
        items.append(F.struct(F.lit(c).alias("column"), F.col("rows").alias("row_count"), F.col(f"{c}__nulls").alias("null_count"),
                              F.coalesce(F.hll_sketch_estimate(f"{c}__hll"), F.lit(0)).cast("bigint").alias("distinct_estimate"),
                              text("min").alias("min_value"), text("max").alias("max_value"), q.alias("quantiles")))
    return merged.select(F.inline(F.array(*items)))


def learn_cuts(merged: DataFrame, column: str, bins: int = 10) -> list[float]:
    """Cuts that deal the sketched values into bins of about equal counts, to
    be kept with the table and used for every later load."""
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = merged.select(F.kll_sketch_get_quantile_double(f"{column}__kll", ranks).alias("q")).first()
    return sorted(set(row["q"] or []))


# ------------------------------------------------------------------- drift


def drift(sketches: DataFrame, order: str = "load") -> DataFrame:
    """Distance of each load from all earlier ones, from the stored bins:
    (load, column, rows, earlier_rows, psi, ks); the first load has none.

    psi, the population stability index, is Σ (p − q) ln(p / q) over the bins
    (nulls are a bin), p and q the shares of the load and of the earlier loads
    after ``SMOOTHING`` was added to each count; ks, the Kolmogorov–Smirnov
    distance, the largest difference of cumulative shares over the bins that
    hold values (for text: in vocabulary order). A load, or a past, without
    rows has distance 0. The rows are one per load, so the window is small.
    """
    names = [c[:-len("__bins")] for c in sketches.columns if c.endswith("__bins")]
    if not names:
        raise ValueError("no binned column among the sketches")
    items = [F.struct(F.lit(n).alias("column"), F.col(f"{n}__bins").alias("bins")) for n in names]
    each = sketches.select(F.col(order).alias("load"), "rows", F.inline(F.array(*items)))
    cells = each.select("load", "column", "rows", F.posexplode("bins").alias("bin", "n"), (F.size("bins") - 1).alias("nulls_bin"),
                        F.size("bins").alias("n_bins"))
    past = Window.partitionBy("column", "bin").orderBy("load").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumns({"m": F.sum("n").over(past), "earlier_rows": F.sum("rows").over(past)}).filter("m IS NOT NULL")
    share = lambda n, total: (F.col(n) + SMOOTHING) / (F.col(total) + F.col("n_bins") * SMOOTHING)
    p, q = share("n", "rows"), share("m", "earlier_rows")
    cells = cells.withColumn("term", (p - q) * F.ln(p / q))
    held = F.col("bin") < F.col("nulls_bin")
    of_load = Window.partitionBy("column", "load")
    upto = of_load.orderBy("bin")
    both = lambda c: F.sum(F.when(held, F.col(c)))
    cells = cells.withColumns({"np": both("n").over(of_load), "mp": both("m").over(of_load)})
    cum = lambda c, total: F.try_divide(both(c).over(upto), F.col(total))
    cells = cells.withColumn("gap", F.when(held, F.abs(cum("n", "np") - cum("m", "mp"))))
    empty = (F.first("rows") == 0) | (F.first("earlier_rows") == 0)
    return cells.groupBy("load", "column").agg(
        F.first("rows").alias("rows"), F.first("earlier_rows").alias("earlier_rows"),
        F.when(empty, 0.0).otherwise(F.sum("term")).alias("psi"),
        F.coalesce(F.max("gap"), F.lit(0.0)).alias("ks"))


def drift_limits(distances: DataFrame, sigmas: float = 4.0, floor_psi: float = 0.1, floor_ks: float = 0.1,
                 least_loads: int = 3) -> DataFrame:
    """``drift`` rows with limits learnt from the loads before each: mean +
    ``sigmas`` standard deviations of their distances, at least the floors;
    the floors alone while fewer than ``least_loads`` distances are known.
    Adds (psi_limit, ks_limit, drifted)."""
    past = Window.partitionBy("column").orderBy("load").rowsBetween(Window.unboundedPreceding, -1)

    def limit(c, floor):
        learnt = F.avg(c).over(past) + sigmas * F.stddev_pop(c).over(past)
        return F.when(F.count(c).over(past) >= least_loads, F.greatest(learnt, F.lit(floor))).otherwise(F.lit(floor))

    out = distances.withColumns({"psi_limit": limit("psi", floor_psi), "ks_limit": limit("ks", floor_ks)})
    return out.withColumn("drifted", (F.col("psi") > F.col("psi_limit")) | (F.col("ks") > F.col("ks_limit")))


def drift_gate(sketches: DataFrame, load, **limits) -> DataFrame:
    """Raise ``QualityError`` when ``load`` drifted from the loads before it,
    else its rows of ``drift_limits`` (one per column)."""
    judged = drift_limits(drift(sketches), **limits).filter(F.col("load") == F.lit(load))
    rows = judged.collect()
    bad = [r for r in rows if r["drifted"]]
    if bad:
        raise QualityError(f"load {load} drifted: " + "; ".join(
            f"{r['column']}: psi {r['psi']:.3f} (limit {r['psi_limit']:.3f}), ks {r['ks']:.3f} (limit {r['ks_limit']:.3f})" for r in bad))
    return sketches.sparkSession.createDataFrame(rows, judged.schema)
