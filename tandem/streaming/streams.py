"""Structured Streaming forms of the operators (ST1-ST4).

Every stream is stateless except the BLEU statistics (ST3), whose state is one row per n-gram
order (4 rows, complete mode).  Sources are file streams (new files in a directory); sinks write
Parquet with the checkpoint under the shared folder, so a restarted query resumes exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arrays as A
from ..functions.text import pretok_words, py_strip
from ..operators.bpe import BpeModel, bpe_encode
from ..operators.clean import nonempty_pairs
from ..operators.encode import ids_udf, shipped_index
from ..operators.logs import DICT_LOG_MARKER, drop_missing, parse_losses
from ..operators.split import hash_split
from ..plans.pipelines import load_bpe_model
from ..sources.store import published
from ..sources.tsv import parse_fields


def encode_stream(sentences: DataFrame, vocab: DataFrame, text: str = "text") -> DataFrame:
    """ST1: sentence stream -> lower-cased words -> ids -> ``[BOS] + ids[:128] + [EOS]``."""
    sent = shipped_index(vocab)                # a stream has no rows to regroup, so the vocabulary must fit
    if sent is None:
        raise ValueError("the vocabulary is too large to send to the workers of a stream")
    ids = ids_udf(sent)(pretok_words(F.lower(F.col(text))))
    return sentences.withColumn("ids", A.wrap_ids(A.truncate_ids(ids)))


def loss_stream(lines: DataFrame) -> DataFrame:
    """ST2: log lines (with a ``file`` column) -> ``file, loss`` rows (F24/F25 by file name, F26)."""
    return drop_missing(parse_losses(lines, dict_format=F.col("file").contains(DICT_LOG_MARKER)))


def clean_stream(lines: DataFrame, mode: str = "DROPMALFORMED") -> DataFrame:
    """ST4: raw pair lines -> parse -> strip -> non-empty -> stateless split tag."""
    pairs = parse_fields(lines, ("en", "zh"), mode)
    pairs = pairs.withColumn("en", py_strip("en")).withColumn("zh", py_strip("zh"))
    return hash_split(nonempty_pairs(pairs), ["pair_id"])


def _row_stats_py(h, r, max_order: int) -> list[list[int]]:
    out = []
    h, r = list(h), list(r)
    for n in range(1, max_order + 1):
        hg = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
        rg = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
        out.append([sum(min(c, rg[g]) for g, c in hg.items()), sum(hg.values()), sum(rg.values())])
    return out


def row_bleu_udf(max_order: int = 4):
    """Per-row clipped matches and totals for n = 1..max_order, linear in the row's tokens (a
    small helper: counting n-grams of one sentence)."""
    @F.pandas_udf(T.ArrayType(T.ArrayType(T.LongType())))
    def stats(h: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([_row_stats_py(a, b, max_order) for a, b in zip(h, r)])
    return stats


def bleu_stats_stream(df: DataFrame, hyp: str, ref: str, max_order: int = 4) -> DataFrame:
    """ST3: per-row statistics -> running sums per n (the state is one row per order)."""
    per_row = df.select(row_bleu_udf(max_order)(F.col(hyp), F.col(ref)).alias("s"))
    ex = per_row.select(F.posexplode("s").alias("i", "x"))
    return ex.groupBy((F.col("i") + 1).alias("n")).agg(
        F.sum(F.col("x")[0]).alias("matches"), F.sum(F.col("x")[1]).alias("total"),
        F.sum(F.col("x")[2]).alias("ref_total"))


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over everything available now (``availableNow``) into Parquet.  Complete
    mode results are rewritten per micro-batch through ``foreachBatch``."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "complete":
        q = w.outputMode("complete").foreachBatch(
            lambda b, _: b.write.mode("overwrite").parquet(path)).start()
    else:
        q = w.outputMode("append").format("parquet").option("path", path).start()
    q.awaitTermination()


def run_to_batches(stream: DataFrame, path: str, checkpoint: str, change=lambda rows: rows) -> None:
    """Run a stream over everything available into ``path/batch=<id>``, each micro-batch through ``change``.  A batch that
    is run again after a failure overwrites its own folder, so no row is lost or written twice."""
    def sink(rows: DataFrame, batch: int) -> None:
        change(rows).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .foreachBatch(sink).start().awaitTermination())


def encode_bpe_stream(sentences: DataFrame, base: str, side: str, path: str, checkpoint: str, text: str = "text",
                      key: Sequence[str] = ("pair_id",)) -> None:
    """ST1: sentence stream -> ``key, ids, model_version`` below ``path`` with the model of ``side`` published last under
    ``base`` (:mod:`tandem.sources.store`).  Every micro-batch looks for the last version, so a new model
    takes effect with the next batch, and a batch has one."""
    spark = sentences.sparkSession
    models: dict[int, BpeModel] = {}

    def change(rows: DataFrame) -> DataFrame:
        number, _ = published(spark, base)
        if number not in models:
            models.clear()
            models[number] = load_bpe_model(spark, base, side, number)
        return bpe_encode(rows, text, models[number], key=list(key)).withColumn("model_version", F.lit(number))

    run_to_batches(sentences, path, checkpoint, change)
