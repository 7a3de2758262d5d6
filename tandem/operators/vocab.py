"""Vocabularies: word counts (A1), alphabet (A2), word vocabulary (A6), size (A5) and the table
form of a tokenizer model (S7).  All counting is a partial + final aggregate; the id orderings use
:func:`dense_position` (no single-partition window)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPECIALS
from .split import dense_position

MIN_FREQ_WORDS = 4          # A6: minimum frequency of the word vocabulary
CHAR_PATTERN = r"(?s)."     # one code point


def specials_frame(spark) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(SPECIALS)], "token string, id int")


def word_counts(df: DataFrame, tokens: Column | str, word_col: str = "word") -> DataFrame:
    """A1: ``word, count`` of the exploded token arrays (map-side partial aggregation absorbs hot
    words before the shuffle)."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return df.select(F.explode(t).alias(word_col)).groupBy(word_col).agg(
        F.count(F.lit(1)).alias("count"))


def alphabet(words: DataFrame, word_col: str = "word", first_id: int = len(SPECIALS)) -> DataFrame:
    """A2: distinct characters of the words, ordered by code point, ids after the specials.
    Bounded by the number of distinct code points."""
    chars = words.select(F.explode(F.regexp_extract_all(F.col(word_col), F.lit(CHAR_PATTERN), 0))
                         .alias("token")).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    ranked = dense_position(chars, ["token"], out="_r")
    return ranked.select("token", (F.col("_r") + first_id).cast("int").alias("id"))


def word_vocab(counts: DataFrame, min_freq: int = MIN_FREQ_WORDS, word_col: str = "word",
               specials: Sequence[str] = SPECIALS) -> DataFrame:
    """Words seen at least ``min_freq`` times, ids by (count desc, word asc) after the
    specials; the specials themselves are the first rows."""
    kept = counts.where((F.col("count") >= min_freq) & ~F.col(word_col).isin(list(specials))) \
        .select(F.col(word_col).alias("token"), (-F.col("count")).alias("_neg"))
    # vocabulary-sized: kept once for the bucket sample and the numbering pass
    kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    ranked = dense_position(kept, ["_neg", "token"], out="_r")
    spark = counts.sparkSession
    spec = spark.createDataFrame([(t, i) for i, t in enumerate(specials)], "token string, id int")
    words = ranked.select(
        "token", (F.col("_r") + len(specials)).cast("int").alias("id"))
    return spec.unionByName(words)


def vocab_size(vocab: DataFrame) -> DataFrame:
    """A5: one row with the number of entries."""
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"))


# ---------------------------------------------------------------------------------------------
# Tokenizer model as tables
# ---------------------------------------------------------------------------------------------

def save_tokenizer(vocab: DataFrame, merges: DataFrame | None, path: str,
                   mode: str = "overwrite") -> None:
    """``vocab(token, id)`` and ``merges(rank, left, right)`` as Parquet under ``path``."""
    vocab.select("token", F.col("id").cast("int")).write.mode(mode).parquet(f"{path}/vocab")
    if merges is not None:
        merges.select(F.col("rank").cast("int"), "left", "right").write.mode(mode) \
            .parquet(f"{path}/merges")


def load_tokenizer(spark, path: str) -> tuple[DataFrame, DataFrame | None]:
    vocab = spark.read.parquet(f"{path}/vocab")
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/merges")
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return vocab, spark.read.parquet(f"{path}/merges") if there else None   # word vocabularies have none
