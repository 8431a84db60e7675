"""Readers for raw and cleaned data, plus time-bounded reads.

Time-bounded reads take their bound as a parameter (never ``now()``), so a
re-run of the same load reads the same rows. On a date-partitioned table
the bound prunes partitions; on parquet it is a pushed filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.schemas import CORRUPT_COL, RAW_EVENT


def json_options(corrupt_col: str = CORRUPT_COL) -> dict:
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col}


def parse_json_lines(df: DataFrame, text_col: str = "value", schema: T.StructType = RAW_EVENT,
                     corrupt_col: str = CORRUPT_COL, keep: list[str] | None = None) -> DataFrame:
    """Parse a column of JSON text; a malformed line (a blank one, too) keeps
    its raw text in ``corrupt_col`` and NULL in every field."""
    parsed = F.from_json(F.col(text_col), schema, json_options(corrupt_col))
    if corrupt_col in schema.fieldNames():      # from_json gives no row at all for a blank line
        parsed = F.coalesce(parsed, _only_corrupt(F.col(text_col), schema, corrupt_col))
    # ``inline`` (a generator) stops filters on the fields from being pushed
    # below the parse, where each would carry its own copy of from_json
    # (pruned to one field, so not shared): one parse per line
    return df.select(*(keep or []), F.inline(F.array(parsed)))


def _only_corrupt(text: F.Column, schema: T.StructType, corrupt_col: str) -> F.Column:
    return F.struct(*[(text if f.name == corrupt_col else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_events_json(spark: SparkSession, path: str, schema: T.StructType = RAW_EVENT,
                     corrupt_col: str = CORRUPT_COL) -> DataFrame:
    """JSON lines in PERMISSIVE mode with malformed lines kept.

    Lines are read as text and parsed with ``from_json``: the result can be
    filtered on the corrupt column alone (a direct JSON scan rejects a query
    that references only that column), and it is one splittable pass.
    """
    return parse_json_lines(spark.read.text(path), "value", schema, corrupt_col)


def _with_corrupt(schema: T.StructType, corrupt_col: str | None) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())]) if corrupt_col else schema


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             corrupt_col: str | None = None) -> DataFrame:
    """CSV files (a header line names the columns, it is no row). With
    ``corrupt_col`` a line that does not parse keeps its text there."""
    r = spark.read.schema(_with_corrupt(schema, corrupt_col)).option("header", header).option("mode", "PERMISSIVE")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.csv(path)


def parse_csv_lines(df: DataFrame, text_col: str, schema: T.StructType, corrupt_col: str | None = None) -> DataFrame:
    """Parse a column of CSV text. With ``corrupt_col`` a line that does not
    parse (a bad number, a missing field, a blank line) keeps its text there."""
    full = _with_corrupt(schema, corrupt_col)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    options = {"mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": corrupt_col} if corrupt_col else {})
    parsed = F.from_csv(F.col(text_col), ddl, options)
    if corrupt_col:
        corrupt = _only_corrupt(F.col(text_col), full, corrupt_col)
        parsed = F.when(F.trim(F.col(text_col)) == "", corrupt).otherwise(F.coalesce(parsed, corrupt))
    # one parse per line: see parse_json_lines
    return df.select(F.inline(F.array(parsed)))


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Catalog table by name, or a parquet table by path."""
    if "/" in name_or_path or name_or_path.startswith("file:"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """True if the table resolves. Only 'not found' answers False; any other
    error (permissions, corrupt metadata) propagates."""
    if "/" in name_or_path or name_or_path.startswith("file:"):
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(name_or_path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(hpath))
    return spark.catalog.tableExists(name_or_path)


def _ts(v, df: DataFrame | None = None, ts_col: str | None = None) -> F.Column:
    """Literal bound typed like the column, so the comparison stays on the
    raw column and is pushed to the scan."""
    kind = "timestamp"
    if df is not None and ts_col is not None:
        kind = df.schema[ts_col].dataType.simpleString()
    return F.lit(v).cast(kind)


def incremental_read(df: DataFrame, ts_col: str, high_water_mark) -> DataFrame:
    """Rows strictly newer than the stored high-water mark (None = all)."""
    if high_water_mark is None:
        return df
    return df.filter(F.col(ts_col) > _ts(high_water_mark, df, ts_col))


def high_water_mark(df: DataFrame, ts_col: str) -> DataFrame:
    """One-row frame with the new mark, to be stored next to the load."""
    return df.agg(F.max(ts_col).alias("high_water_mark"))


def lookback_read(df: DataFrame, ts_col: str, as_of, days: int = 2) -> DataFrame:
    """Rows of the ``days`` calendar days ending with ``as_of`` (inclusive).

    The bound is on the raw column (not a function of it), so parquet and
    partition pruning apply.
    """
    kind = df.schema[ts_col].dataType.simpleString()
    day = dt.date.fromisoformat(str(as_of)[:10])
    end = F.lit(day + dt.timedelta(days=1)).cast(kind)
    start = F.lit(day - dt.timedelta(days=days - 1)).cast(kind)
    c = F.col(ts_col)
    return df.filter((c >= start) & (c < end))


def replay_from(df: DataFrame, ts_col: str, start, end=None) -> DataFrame:
    """Rows with event time in [start, end)."""
    cond = F.col(ts_col) >= _ts(start, df, ts_col)
    if end is not None:
        cond = cond & (F.col(ts_col) < _ts(end, df, ts_col))
    return df.filter(cond)
