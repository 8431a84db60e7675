"""Data-quality checks and rules, each computed in one pass over the data.

Results are small DataFrames (one row per column or rule), so a caller can
write them next to the table, or ``fail_fast`` on them before the write.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _unpivot(row: DataFrame, names: list[str], prefixes: list[str], label: str = "column") -> DataFrame:
    """One-row frame with columns ``{prefix}{i}`` -> one row per name."""
    parts = []
    for i, name in enumerate(names):
        parts.append(F.struct(F.lit(name).alias(label),
                              *[F.col(f"{p}{i}").alias(p.strip("_")) for p in prefixes]))
    return row.select(F.explode(F.array(*parts)).alias("_r")).select("_r.*")


def check_nulls(df: DataFrame, cols) -> DataFrame:
    """(column, null_count, null_percentage) for each column, one scan.

    null_percentage is rounded to 2 places and 0 when the input is empty.
    """
    cols = list(cols)
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{i}") for i, c in enumerate(cols)])
    for i in range(len(cols)):
        row = row.withColumn(
            f"_pct_{i}",
            F.coalesce(F.round(F.try_divide(F.col(f"_nulls_{i}") * 100.0, F.col("_n")), 2), F.lit(0.0)))
    out = _unpivot(row, cols, ["_nulls_", "_pct_"])
    return out.withColumnsRenamed({"nulls": "null_count", "pct": "null_percentage"})


def check_duplicates(df: DataFrame, keys) -> DataFrame:
    """(total_rows, distinct_keys, duplicates); NULL is a key value like
    any other (so this is not ``countDistinct``, which skips NULLs)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumn("duplicates", F.col("total_rows") - F.col("distinct_keys"))


def validate_schema(df: DataFrame, expected) -> set:
    """Missing expected columns (empty set = valid). With a ``StructType``
    the types are compared too and a type mismatch counts as missing."""
    if isinstance(expected, T.StructType):
        actual = {f.name: f.dataType for f in df.schema.fields}
        return {f.name for f in expected.fields
                if f.name not in actual or actual[f.name] != f.dataType}
    return set(expected) - set(df.columns)


def extra_columns(df: DataFrame, expected) -> set:
    names = [f.name for f in expected.fields] if isinstance(expected, T.StructType) else expected
    return set(df.columns) - set(names)


def summary_stats(df: DataFrame) -> DataFrame:
    """(total_rows, total_columns, columns)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        F.lit(",".join(df.columns)).alias("columns"))


# ---------------------------------------------------------------- rules


@dataclass
class Rule:
    name: str
    column: str
    violation: Column | None = None        # row-level predicate, TRUE = violation
    kind: str = "row"                      # row | unique | referential
    parent: DataFrame | None = field(default=None, repr=False)
    parent_column: str | None = None


def is_complete(column: str) -> Rule:
    return Rule("is_complete", column, F.col(column).isNull())


def values_in(column: str, allowed) -> Rule:
    # NULL is judged by is_complete, not here.
    return Rule("values_in", column, F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))


def min_value(column: str, minimum) -> Rule:
    return Rule("min_value", column, F.col(column) < F.lit(minimum))


def max_value(column: str, maximum) -> Rule:
    return Rule("max_value", column, F.col(column) > F.lit(maximum))


def column_relation(name: str, column: str, holds: Column) -> Rule:
    """Rule on several columns: violation where ``holds`` is FALSE."""
    return Rule(name, column, ~F.coalesce(holds, F.lit(True)))


def is_unique(column: str) -> Rule:
    return Rule("is_unique", column, kind="unique")


def referential(column: str, parent: DataFrame, parent_column: str) -> Rule:
    return Rule("referential", column, kind="referential", parent=parent, parent_column=parent_column)


def run_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, column, checked, violations, passed) for every rule.

    Row-level rules share one aggregate scan. Uniqueness is rows minus
    distinct values (a partial aggregate per column); referential
    integrity is a count of the anti join against the parent's distinct
    keys.
    """
    parts = []
    row_rules = [r for r in rules if r.kind == "row"]
    if row_rules:
        row = df.agg(F.count(F.lit(1)).alias("_n"),
                     *[F.count_if(r.violation).alias(f"_v_{i}") for i, r in enumerate(row_rules)])
        items = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                          F.col("_n").alias("checked"), F.col(f"_v_{i}").alias("violations"))
                 for i, r in enumerate(row_rules)]
        parts.append(row.select(F.explode(F.array(*items)).alias("_r")).select("_r.*"))
    for r in rules:
        if r.kind == "unique":
            d = check_duplicates(df, [r.column])
            parts.append(d.select(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                                  F.col("total_rows").alias("checked"),
                                  F.col("duplicates").alias("violations")))
        elif r.kind == "referential":
            keys = (r.parent.select(F.col(r.parent_column).alias(r.column)).distinct()
                    .withColumn("_hit", F.lit(True)))
            # parent keys are distinct, so the left join cannot fan out
            counted = df.select(r.column).join(keys, r.column, "left").agg(
                F.count(F.lit(1)).alias("checked"),
                F.count_if(F.col(r.column).isNotNull() & F.col("_hit").isNull()).alias("violations"))
            parts.append(counted.select(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                                        "checked", "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("violations") == 0)


class QualityError(ValueError):
    pass


def fail_fast(results: DataFrame) -> DataFrame:
    """Raise if any rule failed, else the results as a small frame (one row
    per rule, computed once)."""
    rows = results.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise QualityError("quality rules failed: " + "; ".join(
            f"{r['rule']}({r['column']}): {r['violations']} of {r['checked']}" for r in failed))
    return results.sparkSession.createDataFrame(rows, results.schema)


def corrupt_threshold(total_rows: Column, corrupt_rows: Column, max_ratio: float) -> list[Column]:
    """Columns (corrupt_count, total_count, corrupt_ratio, alarm) for an
    ``agg``; alarm is TRUE when the corrupt share exceeds ``max_ratio``."""
    ratio = F.coalesce(F.try_divide(corrupt_rows.cast("double"), total_rows), F.lit(0.0))
    return [corrupt_rows.alias("corrupt_count"), total_rows.alias("total_count"),
            ratio.alias("corrupt_ratio"), (ratio > F.lit(max_ratio)).alias("alarm")]


def column_profile(df: DataFrame, cols=None, exact: bool = False, samples: int = 0) -> DataFrame:
    """(column, row_count, null_count, distinct_count, min_value, max_value);
    min/max rendered as strings.

    ``exact=False`` is one aggregate over all columns with HyperLogLog++
    distinct counts (bounded memory per column). ``exact=True`` counts each
    column's values (one column read, summed on the map side first), which
    gives the exact distinct count; ``samples`` then adds ``sample_values``,
    the most frequent values as text.
    """
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    orderable = {c: not isinstance(types[c], (T.MapType, T.ArrayType, T.StructType)) for c in cols}
    text = lambda f, c: (f(c).cast("string") if orderable[c] else F.lit(None).cast("string"))
    if exact:
        parts = []
        for c in cols:
            counted = df.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
            part = counted.agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
                F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_count"),
                F.count("v").alias("distinct_count"),
                (F.min("v").cast("string") if orderable[c] else F.lit(None).cast("string")).alias("min_value"),
                (F.max("v").cast("string") if orderable[c] else F.lit(None).cast("string")).alias("max_value"))
            part = part.select(F.lit(c).alias("column"), "*")
            if samples:
                top = (counted.filter("v IS NOT NULL").select(F.col("v").cast("string").alias("v"), "n")
                       .orderBy(F.col("n").desc(), "v").limit(samples))
                top = top.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "v"))),
                                          lambda x: x["v"]).alias("sample_values"))
                part = part.join(top.select(F.lit(c).alias("column"), "sample_values"), "column", "left")
            parts.append(part)
        return reduce(DataFrame.unionByName, parts)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_nulls_{i}"),
                 F.approx_count_distinct(F.col(c)).cast("bigint").alias(f"_distinct_{i}"),
                 text(F.min, c).alias(f"_min_{i}"), text(F.max, c).alias(f"_max_{i}")]
    row = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("column"), F.col("_n").alias("row_count"),
                      F.col(f"_nulls_{i}").alias("null_count"),
                      F.col(f"_distinct_{i}").alias("distinct_count"),
                      F.col(f"_min_{i}").alias("min_value"), F.col(f"_max_{i}").alias("max_value"))
             for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*items)).alias("_r")).select("_r.*")
