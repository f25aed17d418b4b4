"""Session defaults. Jobs take a session from the caller; none of them stops it."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # JSON objects that repeat a key keep the last value, as JSON parsers commonly do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # State of streams grows with the ids they have seen; it belongs on disk, and only what changed into a checkpoint.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "vulnlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``; ``fallback`` (a folder on the same storage as the job's output)
    is used only where that is unset. Without either, a local session gets a temporary folder, and a cluster is an error:
    its executors would each write to a disk of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="run-"))


_local: dict[str, str] = {}


def _at(spark: SparkSession, path: str):
    """A path on whatever storage it names, as Hadoop sees it: its file system and its name."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def path_exists(spark: SparkSession, path: str) -> bool:
    system, name = _at(spark, path)
    return system.exists(name)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the library's own; false where there is none."""
    system, name = _at(spark, path)
    return system.delete(name, True)
