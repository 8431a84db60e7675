"""Open payloads: a JSON object whose keys are not all known beforehand, kept
whole as a VARIANT. Known keys become typed columns; others survive, are
reported as schema drift, and can be lifted to columns later without reading
the raw lines again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_open(df: DataFrame, text: str, known: dict[str, str], payload: str = "payload", corrupt: str = "is_corrupt") -> DataFrame:
    """Add ``payload`` (VARIANT; null where the text is no JSON), a column per
    known key (name -> Spark type; null where it is missing or can't be cast)
    and ``corrupt`` (the text is null, or no JSON object). One parse per row.
    """
    clash = [c for c in [payload, corrupt, *known] if c in df.columns]
    if clash:
        raise ValueError(f"columns already there: {', '.join(clash)}")
    out = df.withColumn(payload, F.try_parse_json(text))
    is_object = F.coalesce(F.schema_of_variant(payload).startswith("OBJECT"), F.lit(False))
    return out.withColumns({**{k: _value(payload, k, t) for k, t in known.items()}, corrupt: ~is_object})


def _value(payload: str, key: str, kind: str) -> Column:
    if '"' not in key or "'" not in key:           # a path quotes a key one way or the other, without escapes
        quote = "'" if "'" not in key else '"'
        return F.try_variant_get(payload, f"$[{quote}{key}{quote}]", kind)
    return F.try_variant_get(F.try_element_at(F.try_variant_get(payload, "$", "map<string,variant>"), F.lit(key)), "$", kind)


def lift(df: DataFrame, key: str, kind: str, name: str | None = None, payload: str = "payload") -> DataFrame:
    """A payload key as a typed column (null: missing, or of another type)."""
    return df.withColumn(name or key, _value(payload, key, kind))


def _entries(payload: str) -> Column:
    return F.map_entries(F.try_variant_get(payload, "$", "map<string,variant>"))


def unknown_keys(df: DataFrame, known, payload: str = "payload") -> Column:
    """Column: sorted keys of the payload that are not in ``known`` (null: no object)."""
    keys = F.transform(_entries(payload), lambda e: e["key"])
    return F.array_sort(F.filter(keys, lambda k: ~k.isin(list(known)))) if known else F.array_sort(keys)


def key_report(df: DataFrame, known, payload: str = "payload") -> DataFrame:
    """Schema drift, from one pass with a partial aggregate: (key, type, rows)
    of the payload's unknown keys; type is BIGINT, DECIMAL, DOUBLE, STRING,
    BOOLEAN, OBJECT, ARRAY or VOID (a JSON null). A key that comes with
    several types has a row for each."""
    e = df.select(F.explode(_entries(payload)).alias("e")).select(F.col("e.key").alias("key"), F.col("e.value").alias("v"))
    if known:
        e = e.filter(~F.col("key").isin(list(known)))
    kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
    return e.groupBy("key", kind.alias("type")).agg(F.count(F.lit(1)).alias("rows"))


def settled_keys(report: DataFrame, least_rows: int = 1) -> DataFrame:
    """Keys of a report that can be lifted as they are: one type throughout
    (JSON nulls aside), in at least ``least_rows`` rows: (key, type, rows)."""
    typed = report.filter("type <> 'VOID'")
    return (typed.groupBy("key").agg(F.count(F.lit(1)).alias("types"), F.first("type").alias("type"), F.sum("rows").alias("rows"))
            .filter((F.col("types") == 1) & (F.col("rows") >= least_rows)).drop("types"))
