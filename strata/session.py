"""Session helpers: a configured SparkSession for tests/bench and the shared
folder used to cut lineage and hold versioned tables.

Cluster settings (executor memory, shuffle partitions) belong to whoever
submits the job; ``get_session`` only fills what is unset.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this package relies on for deterministic results.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
}

# Defaults that are right for large inputs; a cluster config may override them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",     # INT96 has no minimum and maximum to skip by
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


@contextmanager
def indexed_timestamps(spark: SparkSession):
    """Within it, timestamps are written with Parquet's statistics (in a
    session that doesn't say so already)."""
    name = "spark.sql.parquet.outputTimestampType"
    was = spark.conf.get(name)
    spark.conf.set(name, _DEFAULTS[name])
    try:
        yield
    finally:
        spark.conf.set(name, was)


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    conf.update(_REQUIRED)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    On a cluster it must be configured (a machine-local temp folder would
    not survive executor loss). Only a local-mode session without one gets
    a fresh temp folder, as in tests.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():       # each call would make a folder of its own below d
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing sub-path of the shared folder for a table.

    Only the name is made here; the writer creates the folder through the
    file system of the path, so nothing is made on the driver's own disk.
    """
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}/t"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table made under ``new_path`` (with its folder), through the
    file system of the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if p.getName() == "t":
        p = p.getParent()
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
