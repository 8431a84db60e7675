"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import delete_path, new_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Frequent function words of the corpus languages.
FUNCTION_WORDS = frozenset(
    "the of and to in is that it for was on are as with he be by at or this from an a "
    "der die das und in den von zu mit ist des auf für im dem nicht ein eine als auch "
    "de la le et les des en un une du que est pour dans qui par sur au avec pas "
    "el los las del y se por con para al lo su como más no si o".split())

# Largest number of rows of a counted table that may be broadcast, and the
# row width assumed for the bound (key text, numbers).
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a table in the shared folder and read it back: cuts
    the lineage, survives a lost executor, and is computed once."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        delete_path(spark, p)


class Scratch:
    """Tables of one operator's run that its result does not need: staged
    like others, deleted together when the result has been written."""

    def __init__(self):
        self.paths: list[str] = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        out, path = stage(df, name)
        self.paths.append(path)
        return out

    def drop(self, spark: SparkSession) -> None:
        drop(spark, *self.paths)
        self.paths.clear()


def hint_if_small(df: DataFrame, n_rows: int) -> DataFrame:
    """Broadcast a table whose counted rows are within the bound; beyond it
    the join stays a shuffle join, whose skewed partitions AQE splits."""
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Batches of a partition sorted by ``key``, cut so that no group goes
    over a cut: the last group of a batch waits for the next batch."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        values = rows[key].to_numpy()
        last = int(np.flatnonzero(values == values[-1])[0])
        held = rows.iloc[last:]
        if last:
            yield rows.iloc[:last]
    if held is not None and len(held):
        yield held
