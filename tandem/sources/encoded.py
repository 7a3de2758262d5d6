"""Encoded splits as Parquet (S5, S6): one directory partitioned by ``model`` and ``split``.

Loading a split is a partition-pruned read (``PartitionFilters`` on both columns); the reference's
names are kept: ``eval`` is the validation split, ``tokenizer`` loads the tokenizer tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_NAMES = {"train": "train", "eval": "val", "val": "val", "test": "test"}


def write_encoded(df: DataFrame, path: str, model: str, mode: str = "append") -> None:
    """Rows with a ``split`` column -> ``path/model=<model>/split=<split>/*.parquet``."""
    df.withColumn("model", F.lit(model)).write.mode(mode).partitionBy("model", "split").parquet(path)


def load_split(spark: SparkSession, path: str, typ: str, model: str = "t5"):
    """One split of one model; ``typ="tokenizer"`` returns the ``(vocab, merges)`` tables
    saved next to the splits.  Unknown names raise, as in the reference."""
    if typ == "tokenizer":
        from ..operators.vocab import load_tokenizer
        return load_tokenizer(spark, f"{path}/_tokenizer_{model}")
    if typ not in SPLIT_NAMES:
        raise ValueError(f"unknown split {typ!r}; expected one of {sorted(SPLIT_NAMES)} or 'tokenizer'")
    return (spark.read.parquet(path)
            .where((F.col("model") == model) & (F.col("split") == SPLIT_NAMES[typ])))
