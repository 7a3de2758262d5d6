"""Spark session helpers and the shared scratch location.

Everything that must survive an executor loss (checkpoints, written sinks) goes below the
directory the cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent (local
tests) do we create one of our own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "tandem", driver_memory: str = "8g") -> SparkSession:
    master = master or os.environ.get("TANDEM_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Base of the shared folder: ``spark.checkpoint.dir`` if the cluster sets it.

    The RDD checkpoint directory is set from it as well, so ``DataFrame.checkpoint()`` works.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        # only in tests / local runs: nothing names a shared folder
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tandem-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(base, "rdd"))
    return base


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tandem`` importable in Python workers (pandas UDFs pickle functions by module):
    zip the package into the shared folder once and ``addPyFile`` it."""
    import zipfile
    sc = spark.sparkContext
    key = id(sc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    base = shared_dir(spark)
    if "://" in base and not base.startswith("file:"):
        # the zip is a driver-side upload source (Spark serves it to executors); a Hadoop-style
        # shared folder is not writable with Python's zipfile
        base = tempfile.mkdtemp(prefix="tandem-pyfiles-")
    target = os.path.join(base.removeprefix("file:"), "pyfiles", f"tandem-{uuid.uuid4().hex[:8]}.zip")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(key)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (one per call, never reused)."""
    return os.path.join(shared_dir(spark), "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose rows are no longer read."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


_WRITTEN: list[str] = []


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: later steps, and tasks that replace lost ones,
    read the same rows.  :func:`release` deletes it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Drop the intermediates operators persisted or wrote (positions, vocabularies, BPE word tables)
    once their results have been consumed."""
    spark.catalog.clearCache()
    while _WRITTEN:
        drop_path(spark, _WRITTEN.pop())


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
