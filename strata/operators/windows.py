"""Per-key time-window features that stay parallel and linear under a hot
key.

A plain ``Window.partitionBy(user)`` puts every row of one user in one
task, and a sliding RANGE frame re-aggregates its whole buffer whenever a
row leaves it: O(n^2) for a key with n rows in a frame. Both operators here
are prefix sums instead, distributed over (key, time bucket):

* ``trailing`` — RANGE frames [ts - width, ts] (peers included, as SQL
  RANGE) as a sweep: every row adds its value at its time and takes it
  back at time + width + 1 us; a distinct count adds 1 at each occurrence
  of a value and takes it back at the value's next occurrence or at
  time + width + 1 us, whichever comes first. The frame aggregate of a
  row is the prefix sum of all changes at or before its time.
* ``running`` — ROWS UNBOUNDED PRECEDING totals as a distributed prefix
  sum: a running sum inside each (key, bucket) plus the cumulative total of
  the key's earlier buckets (a small per-(key, bucket) table).

Exact: no row is dropped or sampled; results equal the single-partition
window (sums need an exact type: integer or decimal). A NULL key is a key
like any other. A row without a time is in no frame: it keeps its place in
the output with empty aggregates (NULL, counts 0) and adds nothing to others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = 86_400
HOUR = 3_600
_US = 1_000_000
_NEVER = 2**62  # later than any timestamp in microseconds
_NO_ORDER = -2**62  # below any bucket


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list, how: str = "inner") -> DataFrame:
    """Join on ``keys`` in which NULL equals NULL."""
    named = right.withColumnsRenamed({k: f"_j_{k}" for k in keys})
    return left.join(named, [left[k].eqNullSafe(named[f"_j_{k}"]) for k in keys], how).drop(*[f"_j_{k}" for k in keys])


def _next_occurrence(occ: DataFrame, keys: list, bucket_us: int) -> DataFrame:
    """For (keys..., _v, _t_us) rows add ``_next``: the time of the next row
    of the same (keys, value) in time order, or NULL. Found inside the row's time
    bucket with ``lead``, else as the first time of the value's next
    non-empty bucket (from a small per-(keys, value, bucket) table), so a
    hot key is spread over its buckets."""
    part = [*keys, "_v"]
    occ = occ.withColumn("_nb", F.floor(F.col("_t_us") / F.lit(bucket_us)))
    inside = occ.withColumn("_in", F.lead("_t_us").over(
        Window.partitionBy(*part, "_nb").orderBy("_t_us")))
    later = (occ.groupBy(*part, "_nb").agg(F.min("_t_us").alias("_bmin"))
             .select(*part, "_nb", F.min("_bmin").over(
                 Window.partitionBy(*part).orderBy("_nb").rowsBetween(1, Window.unboundedFollowing)
             ).alias("_after")))
    return (_join_null_safe(inside, later, [*part, "_nb"])
            .withColumn("_next", F.coalesce("_in", "_after")).drop("_in", "_after", "_nb"))


def trailing(df: DataFrame, key: str, ts: str, frames: dict, bucket_seconds: int = HOUR,
             target: Column | None = None, running: dict | None = None,
             tiebreak: str | None = None) -> DataFrame:
    """Add trailing-window aggregates to the target rows of ``df``.

    ``frames``: name -> (width_seconds, kind, Column) with kind ``sum``
    (NULL when the frame holds no value), ``count`` (non-NULL values) or
    ``distinct`` (distinct non-NULL values; compared as text when the
    distinct columns differ in type), e.g.
    ``{"spent_24h": (DAY, "sum", F.col("cents"))}``. ``target`` marks the
    rows that get output (default: all); other rows only feed the frames.
    ``bucket_seconds``: time bucket of the distributed prefix sum.
    ``running``: name -> Column (exact type; NULL counts as 0) summed over
    the target rows of the key up to and including this one in
    (ts, ``tiebreak``) order, as ROWS UNBOUNDED PRECEDING over the target
    rows: carried by the same sweep, so running totals need no second
    prefix pass.

    Three branches feed one prefix sum per key: the target rows; one
    ``explode`` per row giving its additions and its removals (one per
    frame width) for all sum / count frames; and, for all distinct frames
    together, each distinct (value, time) with its removal at the next
    occurrence of the value or at time + width + 1 us.
    """
    tgt = F.lit(True) if target is None else F.coalesce(target, F.lit(False))
    rows = df.withColumn("_t_us", _micros(ts))
    timed = rows.filter(F.col("_t_us").isNotNull())
    types = {n: rows.select(c.alias("_v")).schema["_v"].dataType for n, (_, _, c) in frames.items()}
    zero = {}
    for name, (_, kind, _) in frames.items():
        if kind == "sum":
            if not isinstance(types[name], (T.IntegralType, T.DecimalType)):
                raise ValueError(f"trailing sum {name}: needs an exact type (integer or decimal), "
                                 f"got {types[name]}")
            zero[f"_d_{name}"] = F.lit(0).cast(types[name])
            zero[f"_n_{name}"] = F.lit(0).cast("long")
        elif kind in ("count", "distinct"):
            zero[f"_d_{name}"] = F.lit(0).cast("long")
        else:
            raise ValueError(f"unknown trailing kind {kind!r}")
    running = running or {}
    carried = {}
    for name, col in running.items():
        rt = rows.select(col.alias("_v")).schema["_v"].dataType
        if not isinstance(rt, (T.IntegralType, T.DecimalType)):
            raise ValueError(f"running sum {name}: needs an exact type (integer or decimal), got {rt}")
        zero[f"_r_{name}"] = F.lit(0).cast(rt)
        carried[f"_r_{name}"] = F.coalesce(col, F.lit(0).cast(rt))
    changes = []

    def entry(at: Column, deltas: dict) -> Column:
        return F.struct(at.alias("_time"), *[deltas.get(n, z).alias(n) for n, z in zero.items()])

    simple = {n: f for n, f in frames.items() if f[1] != "distinct"}
    if simple:
        add, widths = {}, {}
        for name, (width, kind, col) in simple.items():
            present = col.isNotNull().cast("long")
            if kind == "sum":
                add[f"_d_{name}"] = F.coalesce(col, zero[f"_d_{name}"])
                add[f"_n_{name}"] = present
                widths.setdefault(width, []).extend([f"_d_{name}", f"_n_{name}"])
            else:
                add[f"_d_{name}"] = present
                widths.setdefault(width, []).append(f"_d_{name}")
        entries = [entry(F.col("_t_us"), add)]
        for width, names in sorted(widths.items()):
            entries.append(entry(F.col("_t_us") + F.lit(width * _US + 1), {n: -add[n] for n in names}))
        any_value = F.lit(False)
        for _, _, col in simple.values():
            any_value = any_value | col.isNotNull()
        changes.append(timed.filter(any_value).select(key, F.explode(F.array(*entries)).alias("_c"))
                       .select(key, "_c.*"))

    distinct = {n: f for n, f in frames.items() if f[1] == "distinct"}
    if distinct:
        as_text = len({types[n] for n in distinct}) > 1
        options = [F.struct(F.lit(i).alias("_f"), (c.cast("string") if as_text else c).alias("_v"),
                            F.lit(w * _US + 1).cast("long").alias("_w"))
                   for i, (w, _, c) in enumerate(distinct.values())]
        src = (timed.select(key, "_t_us", F.explode(F.array(*options)).alias("_o"))
               .select(key, "_t_us", "_o.*").filter(F.col("_v").isNotNull()))
        # no distinct needed: of equal (value, time) copies all but the last
        # in lead order end at their own time, so they add nothing
        occ = _next_occurrence(src, [key, "_f", "_w"], bucket_seconds * _US)
        until = F.least(F.coalesce(F.col("_next"), F.lit(_NEVER)), F.col("_t_us") + F.col("_w"))
        plus = {f"_d_{n}": F.when(F.col("_f") == i, 1).otherwise(0).cast("long")
                for i, n in enumerate(distinct)}
        changes.append(occ.select(key, F.explode(F.array(
            entry(F.col("_t_us"), plus), entry(until, {n: -v for n, v in plus.items()}))).alias("_c"))
            .select(key, "_c.*"))

    # query rows sort after the changes at the same time (peers are
    # included), and among themselves by ``tiebreak`` (running totals)
    tb = F.col(tiebreak) if tiebreak else F.lit(0)
    sweep = (rows.filter(tgt).withColumn("_time", F.col("_t_us")).drop("_t_us")
             .withColumns(zero).withColumns(carried)
             .withColumn("_qt", F.struct(F.lit(1).alias("q"), tb.alias("t"))))
    for c in changes:
        sweep = sweep.unionByName(c.withColumns({n: zero[n] for n in carried})
                                  .withColumn("_qt", F.struct(F.lit(0).alias("q"), F.lit(None).cast(
                                      sweep.schema["_qt"].dataType["t"].dataType).alias("t"))),
                                  allowMissingColumns=True)
    out = prefix(sweep, key, F.col("_time"), "_qt", {n: ("sum", F.col(n)) for n in zero},
                 bucket_seconds * _US).filter(F.col("_qt.q") == 1)
    result = {name: F.col(f"_r_{name}") for name in running}
    for name, (_, kind, _) in frames.items():
        v = F.col(f"_d_{name}")
        result[name] = F.when(F.col(f"_n_{name}") > 0, v) if kind == "sum" else F.coalesce(v, F.lit(0).cast("long"))
    return out.withColumns(result).drop("_time", "_qt", *zero)


def running(df: DataFrame, key: str, ts: str, tiebreak: str, sums: dict,
            bucket_seconds: int = DAY) -> DataFrame:
    """Add running totals (this row and all earlier rows of the key, by
    (ts, tiebreak)) for each name -> Column in ``sums``, plus
    ``running_count``."""
    aggs = {n: ("sum", c) for n, c in sums.items()}
    aggs["running_count"] = ("count", F.lit(1))
    return prefix(df, key, _micros(ts), tiebreak, aggs, bucket_seconds * _US)


_INNER = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}
_OUTER = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.sum}


def _combine(kind: str, pre: Column, inner: Column) -> Column:
    if kind == "max":
        return F.greatest(pre, inner)
    if kind == "min":
        return F.least(pre, inner)
    if kind == "count":
        return F.coalesce(pre, F.lit(0)) + F.coalesce(inner, F.lit(0))
    return F.when(pre.isNull() & inner.isNull(), F.lit(None)).otherwise(
        F.coalesce(pre, F.lit(0)) + F.coalesce(inner, F.lit(0)))


def prefix(df: DataFrame, key: str, order: Column, tiebreak: str, aggs: dict,
           bucket_width: int, include_current: bool = True) -> DataFrame:
    """Prefix aggregates per key along a numeric ``order`` (then
    ``tiebreak``): name -> (kind, Column) with kind in sum/max/min/count.
    With ``include_current=False`` only strictly earlier rows count (NULL,
    or 0 for count, when there are none). Rows without an ``order`` stay,
    with empty aggregates.

    Rows are bucketed by ``floor(order / bucket_width)``; the window runs
    per (key, bucket), and each bucket adds the combined result of the
    key's earlier buckets (a small per-(key, bucket) table).
    """
    # rows without an order get buckets of their own, which no total counts
    rows = (df.withColumn("_o", order)
            .withColumn("_b", F.coalesce(F.floor(F.col("_o") / F.lit(bucket_width)),
                                         F.lit(_NO_ORDER) - F.pmod(F.xxhash64(tiebreak), F.lit(1024)))))
    upper = Window.currentRow if include_current else -1
    inside = Window.partitionBy(key, "_b").orderBy("_o", tiebreak).rowsBetween(
        Window.unboundedPreceding, upper)
    totals = rows.filter("_o IS NOT NULL").groupBy(key, "_b").agg(
        *[_INNER[k](c).alias(f"_bt_{n}") for n, (k, c) in aggs.items()])
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(key, "_b", *[_OUTER[k](f"_bt_{n}").over(before).alias(f"_pre_{n}")
                                        for n, (k, _) in aggs.items()])
    inner = rows.withColumns({f"_in_{n}": _INNER[k](c).over(inside) for n, (k, c) in aggs.items()})
    out = _join_null_safe(inner, totals, [key, "_b"], "left")
    out = out.withColumns({n: F.when(F.col("_o").isNotNull(), _combine(k, F.col(f"_pre_{n}"), F.col(f"_in_{n}")))
                           .otherwise(F.lit(0 if k == "count" else None)) for n, (k, _) in aggs.items()})
    return out.drop("_o", "_b", *[f"_in_{n}" for n in aggs], *[f"_pre_{n}" for n in aggs])
