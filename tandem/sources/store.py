"""Published versions of encoded data (S5-S7): model tables and splits that belong together, committed together.

``publish`` writes a version into a folder of its own (first phase: nobody reads it) and then creates one
small commit file that names it (second phase); creating fails if the file is there, so two writers get two
numbers.  Readers only look at commit files: they see a version whole or not at all, and the splits they
load were encoded with the tables they load.  A writer that dies leaves a folder without a commit.
Layout: ``<base>/_commits/<number>`` and ``<base>/v-<id>/{tables/<name>, splits/split=<split>}``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path
from .encoded import SPLIT_NAMES

COMMITS = "_commits"


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers that have been committed or are being committed, ascending."""
    fs, at = _fs(spark, f"{base}/{COMMITS}")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit()) if fs.exists(at) else []


def _commit(spark: SparkSession, base: str, name: str) -> int:
    while True:
        number = max(versions(spark, base), default=0) + 1
        fs, at = _fs(spark, f"{base}/{COMMITS}/{number:09d}")
        try:
            out = fs.create(at, False)
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            continue                     # another writer took the number
        out.write(bytearray(name.encode()))
        out.close()
        return number


def published(spark: SparkSession, base: str, number: int | None = None) -> tuple[int, str]:
    """(number, folder) of a committed version, the last one by default."""
    for n in reversed(versions(spark, base)) if number is None else [number]:
        fs, at = _fs(spark, f"{base}/{COMMITS}/{n:09d}")
        if fs.exists(at):
            size = fs.getFileStatus(at).getLen()
            if size:                     # else its writer has not finished the commit
                source = fs.open(at)
                name = bytes(source.readNBytes(size)).decode()
                source.close()
                return n, f"{base}/{name}"
    raise ValueError(f"no published version {'' if number is None else number} in {base}")


def publish(spark: SparkSession, base: str, write: Callable[[str], None]) -> int:
    """Commit what ``write(folder)`` writes as the next version; nothing is published if it fails."""
    name = f"v-{uuid.uuid4().hex[:12]}"
    try:
        write(f"{base}/{name}")
    except BaseException:
        drop_path(spark, f"{base}/{name}")
        raise
    return _commit(spark, base, name)


def publish_encoded(spark: SparkSession, base: str, tables: dict[str, DataFrame], rows: DataFrame | None = None) -> int:
    """S5 + S7: ``tables`` (vocabularies, merges, pieces) and, if given, ``rows`` with a ``split`` column as one version.
    Rows are rebalanced by split, so files have the session's advisory size and a large split has many."""
    def write(folder: str) -> None:
        for name, table in tables.items():
            table.write.parquet(f"{folder}/tables/{name}")
        if rows is not None:
            rows.hint("rebalance", "split").write.partitionBy("split").parquet(f"{folder}/splits")
    return publish(spark, base, write)


def load_table(spark: SparkSession, base: str, name: str, number: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{published(spark, base, number)[1]}/tables/{name}")


def load_published(spark: SparkSession, base: str, typ: str, number: int | None = None) -> DataFrame:
    """One split of a committed version (``eval`` is ``val``), a partition-pruned read."""
    if typ not in SPLIT_NAMES:
        raise ValueError(f"unknown split {typ!r}; expected one of {sorted(SPLIT_NAMES)}")
    rows = spark.read.parquet(f"{published(spark, base, number)[1]}/splits")
    return rows.where(F.col("split") == SPLIT_NAMES[typ])
