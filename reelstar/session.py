"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every entry point applies to the session it is given.
#  * UTC: event time is parsed with a quoted 'Z', i.e. as wall clock in the
#    session zone; only UTC makes that equal the instant.
#  * dynamic partition overwrite: a run replaces only the days it rebuilt.
#  * AQE: runtime join re-planning, skew-join splitting and partition
#    coalescing; the fall-back whenever a static broadcast is not proven safe.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "reelstar") -> SparkSession:
    """A local session for tests and the benchmark (UI off, no servers)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("REELSTAR_DRIVER_MEMORY", "8g"))
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session; only when it is unset in a local run is a folder
    of our own created and registered. A cluster without one is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="reelstar-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it; absent is fine."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder on whatever file system holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def folder_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder with the bytes of the files below each."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return sorted((s.getPath().getName(), fs.getContentSummary(s.getPath()).getLength()) for s in fs.listStatus(target))


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"can't move {source} to {target}")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/reelstar-{label}-{uuid.uuid4().hex[:12]}"
