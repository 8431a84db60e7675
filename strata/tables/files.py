"""Table folders on the file system of their path: look up, rename, publish.

A written folder takes the place of a table by two renames, so a job that
fails leaves the table as it was. What a driver that dies between the renames
leaves behind (the old table under ``<path>__old-…``) is put back by
``recover``, which every writer calls first. One writer per table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

OLD, NEW = "__old-", "__new-"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"could not rename {source} to {target}")


def folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Name -> path of the folders in ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    return {st.getPath().getName(): st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory()}


def beside(path: str, mark: str) -> str:
    """A fresh path next to a table, on the same file system."""
    return f"{path.rstrip('/')}{mark}{uuid.uuid4().hex}"


def _left_over(spark: SparkSession, path: str) -> list[str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return sorted(p for n, p in folders(spark, parent).items() if n.startswith(name + OLD))


def recover(spark: SparkSession, path: str) -> None:
    """Finish a replacement that a dead driver left half done: the old table
    comes back if there is no new one; of a table replaced by partitions, the
    partitions that have no new one come back."""
    for old in _left_over(spark, path):
        if not exists(spark, path):
            rename(spark, old, path)
            continue
        if exists(spark, f"{old}/_partitions"):
            held = folders(spark, path)
            for name, where in folders(spark, old).items():
                if "=" in name and name not in held:
                    rename(spark, where, f"{path.rstrip('/')}/{name}")
        remove(spark, old)


def publish(spark: SparkSession, fresh: str, path: str) -> None:
    """The written folder ``fresh`` becomes the table at ``path``."""
    old = beside(path, OLD)
    held = exists(spark, path)
    if held:
        rename(spark, path, old)
    try:
        rename(spark, fresh, path)
    except BaseException:
        if held:
            rename(spark, old, path)
        raise
    if held:
        remove(spark, old)


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Name -> bytes of the data files in a folder."""
    fs, p = _fs(spark, path)
    return {st.getPath().getName(): st.getLen() for st in fs.listStatus(p) if st.isFile() and not st.getPath().getName().startswith(("_", "."))}


def publish_partitions(spark: SparkSession, fresh: str, path: str, names, grown=()) -> None:
    """The partition folders ``names`` of ``path`` become those of the
    written folder ``fresh``; one that ``fresh`` doesn't have goes. The folders
    ``grown`` keep their files and get those of ``fresh``."""
    old, new, held = beside(path, OLD), folders(spark, fresh), folders(spark, path)
    root = path.rstrip("/")
    fs, p = _fs(spark, f"{old}/_partitions")
    fs.create(p).close()                       # tells ``recover`` that these are partitions
    aside, placed = [], []
    try:
        for n in names:
            if n in held:
                rename(spark, held[n], f"{old}/{n}")
                aside.append(n)
            if n in new:
                rename(spark, new[n], f"{root}/{n}")
                placed.append(n)
        for n in (n for n in grown if n in new):
            for each in [f"{n}/{f}" for f in data_files(spark, new[n])] if n in held else [n]:
                rename(spark, f"{fresh}/{each}", f"{root}/{each}")
                placed.append(each)
    except BaseException:
        for n in placed:
            remove(spark, f"{root}/{n}")
        for n in aside:
            rename(spark, f"{old}/{n}", f"{root}/{n}")
        remove(spark, old)                     # only when every partition is back; else ``recover`` needs it
        raise
    finally:
        remove(spark, fresh)
    remove(spark, old)
