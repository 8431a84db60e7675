"""Table writes on path-based parquet: replace, partitioned, upsert.

Parquet has no row-level MERGE, and a table must not be lost when a job
fails. A replacement is therefore written beside the table and takes its
place by renames (``tables.files``): the whole table, or in an upsert the
folders of the touched partitions, written once; a partition that only gets
new rows keeps its files and gets more of them. A stored index of keys
(``tables.key_index``) names the partitions that can hold older copies of a
load's rows, so that a small load doesn't read the keys of the whole table.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import delete_path, new_path
from strata.tables import files, key_index


def write_replace(df: DataFrame, path: str) -> None:
    """Replace a table by ``df`` (which may read it). It is written beside
    the table and published when it is complete: a job that fails changes
    nothing."""
    spark = df.sparkSession
    files.recover(spark, path)
    fresh = files.beside(path, files.NEW)
    try:
        df.write.parquet(fresh)
        files.publish(spark, fresh, path)
    finally:
        files.remove(spark, fresh)


def write_partitioned(df: DataFrame, path: str, partition_col: str, mode: str = "overwrite") -> None:
    """Write identity-partitioned by ``partition_col``; with dynamic
    partition overwrite only the partitions present in ``df`` are replaced.

    The ``rebalance`` hint hashes rows by the partition column and lets AQE
    split an oversized (hot) partition value into advisory-size tasks and
    merge small ones: no single task holds a hot date, and small dates do
    not produce one tiny file per task.
    """
    (df.hint("rebalance", partition_col)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def _all_present(keys):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def merge_upsert(target: DataFrame, updates: DataFrame, keys, order_col: str | None = None) -> DataFrame:
    """MERGE semantics as a DataFrame: target rows whose key occurs in
    ``updates`` are replaced by the update, all other target rows stay, all
    other updates are inserted. NULL keys never match: such rows stay and are
    inserted, on every run (as in SQL MERGE).

    Rows are never picked by position: several untouched target rows of one
    key all stay, several new rows of one key are all inserted (a first load
    and a later load treat them alike). More than one update row for a key
    that the target holds is an error of the input; see
    ``check_merge_cardinality``.

    ``order_col``: a key whose newest update is older than its newest target
    row is left as it is (a late re-delivery of an old version does not win).
    """
    keys = list(keys)
    present = updates.filter(_all_present(keys))
    if order_col is None:
        kept, new = target.join(present.select(*keys), keys, "left_anti"), updates
    else:
        newest = present.groupBy(*keys).agg(F.max(order_col).alias("_newest"))
        held = target.filter(_all_present(keys)).groupBy(*keys).agg(F.max(order_col).alias("_held"))
        lost = newest.join(held, keys).filter(
            F.col("_held").isNotNull() & (F.col("_newest").isNull() | (F.col("_newest") < F.col("_held")))).select(*keys)
        won = newest.select(*keys).join(lost, keys, "left_anti")
        kept, new = target.join(won, keys, "left_anti"), updates.join(lost, keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def merge_cardinality_violations(target: DataFrame, updates: DataFrame, keys) -> DataFrame:
    """Target keys matched by more than one update row (MERGE must fail on
    these): (keys..., source_rows). Updates are counted per key first
    (partial aggregate), then semi-joined to the target's keys."""
    keys = list(keys)
    per_key = updates.filter(_all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"))
    multi = per_key.filter(F.col("source_rows") > 1)
    return multi.join(target.select(*keys).distinct(), keys, "left_semi")


class MergeCardinalityError(ValueError):
    pass


def check_merge_cardinality(target: DataFrame, updates: DataFrame, keys) -> None:
    bad = merge_cardinality_violations(target, updates, keys).limit(5).collect()
    if bad:
        raise MergeCardinalityError(f"update keys match more than one source row, e.g. {bad}")


_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
CROWD, CROWD_BYTES = 16, 32_000_000


def in_partitions(partition_col: str, values) -> F.Column:
    """Filter on listed partition values (text), the NULL partition included."""
    part = F.col(partition_col)
    cond = part.cast("string").isin([v for v in values if v != _NULL_PARTITION])
    return cond | part.isNull() if _NULL_PARTITION in values else cond


def _values(df: DataFrame, partition_col: str) -> set:
    """Partition values (text) of a frame: a row per partition comes back."""
    rows = df.select(F.col(partition_col).cast("string").alias("p")).distinct().collect()
    return {r["p"] if r["p"] is not None else _NULL_PARTITION for r in rows}


def _crowded(spark: SparkSession, folder: str) -> bool:
    """Many small files, which are better written anew than added to."""
    sizes = files.data_files(spark, folder).values()
    return len(sizes) >= CROWD and sum(sizes) < CROWD_BYTES * len(sizes)


def may_hold(spark: SparkSession, path: str, loaded: DataFrame, keys) -> set:
    """Partition values (text) of an indexed table that can hold a key of ``loaded``."""
    return key_index.candidates(spark, path, loaded, list(keys))


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, keys, partition_col: str,
                      order_col: str | None = None, check_cardinality: bool = True,
                      remove: DataFrame | None = None, ignore_changes_in=None, written: bool = False,
                      indexed: bool = False, found_in: set | None = None, later=None) -> list:
    """Partition-scoped ``merge_upsert`` into a live partitioned table.

    Touched partitions are those of the updates plus those where a matched
    target row lives now (a late event can move a session to another date,
    leaving its old partition to be rewritten or emptied). Of these, the ones
    with a matched or removed row are read (partition pruning), merged, written
    once beside the table, and published by renaming their folders; partitions
    left empty go. The others get their new rows as more files (until there are
    many small ones; not if their columns are others), so such a load costs its
    own rows and not the table's. A failure before that changes nothing.
    Re-running an upsert whose keys are all set gives the same table.

    ``remove``: keys whose rows are deleted. ``ignore_changes_in``: columns
    (an audit time) that alone make no change; when given, updates equal to
    their target row in all other columns are dropped first, so a re-run with
    nothing new rewrites nothing. ``written``: ``updates`` reads a written
    table and needs no copy of its own. ``indexed``: keep a key index, and
    look for older copies only where it says they can be; ``found_in``: its
    answer for the keys of ``updates`` and ``remove``, if it was asked before;
    ``later``: takes the function that writes the index of the published
    partitions, to run beside other jobs (until then these partitions count as
    ones that can hold any key). Returns the touched partition values (text).
    """
    keys = list(keys)
    scratch = []

    def staged(df: DataFrame, name: str) -> DataFrame:
        scratch.append(new_path(spark, name))
        df.write.parquet(scratch[-1])
        return spark.read.schema(df.schema).parquet(scratch[-1])

    fresh = files.beside(path, files.NEW)

    def publish(rows: DataFrame, touched, grown=frozenset()) -> None:
        write_partitioned(rows, fresh, partition_col)
        folder = {v: p.rpartition("/")[2] for where in (fresh, path) for v, p in _partition_dirs(spark, where, partition_col).items()}
        files.publish_partitions(spark, fresh, path, [folder[v] for v in touched if v in folder and v not in grown],
                                 [folder[v] for v in touched if v in folder and v in grown])
        if indexed and folder:
            (later or (lambda job: job()))(lambda: key_index.write(spark, path, keys, partition_col, touched, _NULL_PARTITION))

    try:
        files.recover(spark, path)
        if not written:
            updates = staged(updates, "updates")
        if not files.exists(spark, path) or not list_partitions(spark, path, partition_col):
            publish(updates, _values(updates, partition_col))
            return list_partitions(spark, path, partition_col)
        target = spark.read.parquet(path)
        own = _values(updates, partition_col)
        if remove is not None:
            remove = staged(remove.select(*keys).distinct(), "remove")
        if indexed and found_in is None:
            sought = updates.select(*keys)
            found_in = may_hold(spark, path, sought if remove is None else sought.unionByName(remove), keys)
        if ignore_changes_in is not None:
            same = [c for c in updates.columns if c not in ignore_changes_in]
            if set(same) <= set(target.columns):
                row = F.struct(*[F.col(c).cast(updates.schema[c].dataType) for c in same])
                held = target.filter(in_partitions(partition_col, own)).select(
                    *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], row.alias("_held"))
                match = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
                updates = staged(updates.withColumn("_row", F.struct(*same)).join(
                    held, [*match, F.col("_row").eqNullSafe(F.col("_held"))], "left_anti").drop("_row"), "updates")
                own = _values(updates, partition_col)

        sought = target if found_in is None else target.filter(in_partitions(partition_col, found_in | own))
        per_key = updates.filter(_all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        stats = (sought.select(*keys, partition_col).join(per_key, keys)
                 .groupBy(F.col(partition_col).cast("string").alias("p")).agg(F.max("_n").alias("n")).collect())
        if check_cardinality and any(r["n"] > 1 for r in stats):
            raise MergeCardinalityError("update keys match a target row more than once")
        changed = {r["p"] if r["p"] is not None else _NULL_PARTITION for r in stats}
        if remove is not None:
            changed |= _values(sought.select(*keys, partition_col).join(remove, keys, "left_semi"), partition_col)
        touched = changed | own
        if not touched:
            return []

        dirs = _partition_dirs(spark, path, partition_col)
        kinds = lambda df: {(f.name, f.dataType) for f in df.schema.fields}
        alike = kinds(updates) == kinds(target)
        changed |= {v for v in own - changed if v in dirs and (not alike or _crowded(spark, dirs[v]))}
        merged = updates
        if changed:
            old = target.filter(in_partitions(partition_col, changed))
            if remove is not None:
                old = old.join(remove, keys, "left_anti")
            merged = merge_upsert(old, updates, keys, order_col)
        publish(merged, touched, touched - changed)
        return sorted(touched)
    finally:
        files.remove(spark, fresh)
        for p in scratch:
            delete_path(spark, p)


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, keys, order_col: str | None = None) -> None:
    """``merge_upsert`` into an unpartitioned table (a dimension)."""
    files.recover(spark, path)
    merged = updates
    if files.exists(spark, path):
        target = spark.read.parquet(path)
        check_merge_cardinality(target, updates, keys)
        merged = merge_upsert(target, updates, keys, order_col)
    write_replace(merged, path)


def _partition_dirs(spark: SparkSession, path: str, partition_col: str) -> dict:
    """Partition value (text) -> folder, from the folder listing."""
    prefix = f"{partition_col}="
    return {unquote(name[len(prefix):]): where for name, where in files.folders(spark, path).items() if name.startswith(prefix)}


def list_partitions(spark: SparkSession, path: str, partition_col: str) -> list:
    """Partition values of a table folder, from the folder listing (no job)."""
    return sorted(_partition_dirs(spark, path, partition_col))


def evolve_schema(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both frames under the union of their columns (added columns
    are NULL for old rows)."""
    return old.unionByName(new, allowMissingColumns=True)


def quarantine_write(corrupt: DataFrame, path: str) -> None:
    """Append corrupt raw lines as text (one file set per load)."""
    corrupt.write.mode("append").text(path)
