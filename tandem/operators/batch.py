"""Batches for a model: consecutive batches (W1), first rows per batch (W4), step schedule (W5, P8),
truncate / wrap / pad (F9-F12), shift and masks (F14-F16), transpose (F20), token rows (F21) and a
user collate callable per batch (X1).

A batch holds at most ``size`` rows, so every window or regroup keyed by a batch is bounded by
construction; positions inside a split come from :func:`dense_position` (no global window).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.text import PAD_ID
from .split import dense_position, hash_key_buckets

TRAIN_BATCH, EVAL_BATCH, GENERATE_BATCH = 128, 512, 2048
LOG_EVERY, SAVE_EVERY = 100, 10_000


def assign_batches(df: DataFrame, order: Sequence[str], size: int = TRAIN_BATCH,
                   by: Sequence[str] = ("split",), key_bucket: str | None = "shuffle_key"
                   ) -> DataFrame:
    """Consecutive batches of ``size`` rows in ``order`` within each ``by`` group (the last
    one short): ``batch_id = floor(pos / size)``, ``row_in_batch = pos % size``; ``n_batches``
    per group comes from the group size that the dense position already computes."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = hash_key_buckets(key_bucket, n) if key_bucket else None
    pos = dense_position(df, list(order), by=list(by), out="pos", total="_n", bucket=bucket,
                         num_partitions=n)
    return batches_at(pos, size, "pos", "_n").drop("_n")


def batches_at(df: DataFrame, size: int = TRAIN_BATCH, pos: str = "split_pos", total: str = "split_size") -> DataFrame:
    """W1 for rows whose place in their split is known (``exact_split`` gives it): arithmetic only, no shuffle."""
    return df.withColumns({
        "batch_id": F.floor(F.col(pos) / size).cast("bigint"),
        "row_in_batch": (F.col(pos) % size).cast("int"),
        "n_batches": F.ceil(F.col(total) / size).cast("bigint")})


def first_k_per_batch(df: DataFrame, k: int = 2, batch_cols: Sequence[str] = ("split", "batch_id"),
                      order: str = "row_in_batch") -> DataFrame:
    """The first ``k`` rows of each batch (T17: the Transformer's BLEU sample).  The row
    index inside the batch is already known from W1, so this is a plain filter (no window)."""
    return df.where(F.col(order) < k)


def step_schedule(batches: DataFrame, epochs: int = 5) -> DataFrame:
    """Global step of every (epoch, batch): ``epoch * n_batches + i + 1``.  ``batches`` has
    one row per batch with ``batch_id`` and ``n_batches``; epochs are exploded per row."""
    ex = batches.select("batch_id", "n_batches",
                        F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    return ex.select(F.col("epoch").cast("int").alias("epoch"), "batch_id",
                     (F.col("epoch") * F.col("n_batches") + F.col("batch_id") + 1).alias("step"))


def every_nth(schedule: DataFrame, log_every: int = LOG_EVERY, save_every: int = SAVE_EVERY,
              i_col: str = "batch_id", step_col: str = "step") -> DataFrame:
    """Steps that log (``i % log_every == 0``, ``i`` restarts each epoch) or save
    (``step % save_every == 0``, global)."""
    log = (F.col(i_col) % log_every) == 0
    save = (F.col(step_col) % save_every) == 0
    return schedule.withColumn("log", log).withColumn("save", save).where(log | save)


def wrap_and_truncate(df: DataFrame, ids: str, out: str | None = None, n: int = A.MAX_IDS
                      ) -> DataFrame:
    """F9 + F10: ``[BOS] + ids[:n] + [EOS]`` (so at most n + 2 ids, T14)."""
    return df.withColumn(out or ids, A.wrap_ids(A.truncate_ids(F.col(ids), n)))


def pad_batches(df: DataFrame, ids: str, batch_cols: Sequence[str] = ("split", "batch_id"),
                fill: int = PAD_ID, out: str | None = None) -> DataFrame:
    """F11 + A12: right-pad every row to the longest row of its batch (bounded window)."""
    w = Window.partitionBy(*batch_cols)
    m = F.max(F.size(ids)).over(w)
    return df.withColumn(out or ids, A.pad_to(F.col(ids), m, fill))


def pad_for_t5(df: DataFrame, ids: str, labels: str,
               batch_cols: Sequence[str] = ("split", "batch_id")) -> DataFrame:
    """mT5 collate: ids padded with 0, attention mask 1s padded with 0, labels padded with
    -100, each to its batch's longest."""
    w = Window.partitionBy(*batch_cols)
    m_in = F.max(F.size(ids)).over(w)
    m_lab = F.max(F.size(labels)).over(w)
    return (df.withColumn("attention_mask", A.pad_to(F.array_repeat(F.lit(1), F.size(ids)), m_in, 0))
            .withColumn(ids, A.pad_to(F.col(ids), m_in, A.T5_PAD_ID))
            .withColumn(labels, A.pad_to(F.col(labels), m_lab, A.LABEL_IGNORE)))


def model_batches(df: DataFrame, src: str, tgt: str,
                  batch_cols: Sequence[str] = ("split", "batch_id")) -> DataFrame:
    """C4: wrapped, padded source and target, decoder input/output shift and the pad masks.  The square source and
    target masks are the same for all rows of a batch: :func:`batch_masks` gives them once a batch."""
    x = wrap_and_truncate(wrap_and_truncate(df, src), tgt)
    x = pad_batches(pad_batches(x, src, batch_cols), tgt, batch_cols)
    return (x.withColumn("tgt_in", A.decoder_input(F.col(tgt)))
            .withColumn("tgt_out", A.decoder_target(F.col(tgt)))
            .withColumn("src_pad_mask", A.padding_mask(F.col(src)))
            .withColumn("tgt_pad_mask", A.padding_mask(F.col("tgt_in"))))


def batch_masks(batches: DataFrame, src: str, tgt_in: str = "tgt_in",
                batch_cols: Sequence[str] = ("split", "batch_id")) -> DataFrame:
    """F15 + F16 of :func:`model_batches`, one row per batch: the sides' padded lengths, ``src_mask`` (source x source, all
    false) and ``tgt_mask`` (target x target, 0 on and below the diagonal, -inf above).  Every row of a batch has the
    same lengths, so only two numbers a batch leave the tasks and the masks are made from them on read."""
    sizes = batches.groupBy(*batch_cols).agg(F.max(F.size(src)).alias("src_len"), F.max(F.size(tgt_in)).alias("tgt_len"))
    return sizes.withColumns({"src_mask": A.source_mask(F.col("src_len")), "tgt_mask": A.causal_mask(F.col("tgt_len"))})


def causal_masks(lengths: DataFrame, n: str = "n") -> DataFrame:
    """F16: one mask per distinct length (joined to batches by length, a bounded broadcast)."""
    return lengths.select(n).distinct().withColumn("mask", A.causal_mask(F.col(n)))


def transpose_batches(df: DataFrame, ids: str, batch_cols: Sequence[str] = ("split", "batch_id"),
                      row: str = "row_in_batch") -> DataFrame:
    """batch-major rows -> time-major columns (``[T, B]`` view): one row per (batch, t)
    with the ids of all rows at step t, in row order.  Groups hold one batch: its rows are brought together whole, one value
    a row (no exchange behind :func:`pad_batches`, which groups by the same columns), and are turned inside the row."""
    rows = df.select(*batch_cols, F.struct(F.col(row).alias("r"), F.col(ids).alias("x")).alias("_r"))
    whole = rows.groupBy(*batch_cols).agg(F.collect_list("_r").alias("_rows"), F.max(F.size("_r.x")).alias("_n"))

    def step(t):
        there = F.filter("_rows", lambda y: F.size(y["x"]) > t)
        at = F.sort_array(F.transform(there, lambda y: F.struct(y["r"].alias("r"), F.get(y["x"], t).alias("id"))))
        return F.transform(at, lambda y: y["id"])

    return whole.where(F.col("_n") > 0).select(
        *batch_cols, F.posexplode(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), step)).alias("t", "ids"))


def token_rows(df: DataFrame, ids: str, keep: Sequence[str]) -> DataFrame:
    """flatten to one row per token."""
    return df.select(*keep, F.posexplode(ids).alias("t", "id"))


def collate_with(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                 batch_cols: Sequence[str] = ("split", "batch_id")) -> DataFrame:
    """A user collate callable applied to each batch as a pandas frame (Arrow transfer).
    Groups are batches, so each call holds at most the batch size in rows."""
    return df.groupBy(*batch_cols).applyInPandas(fn, schema)


def pad_collate(ids: str, fill: int = PAD_ID) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The reference's collate (pad to the batch's longest) as a pandas callable for X1."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        m = int(pdf[ids].map(len).max()) if len(pdf) else 0
        pdf = pdf.copy()
        pdf[ids] = pdf[ids].map(lambda a: list(a) + [fill] * (m - len(a)))
        return pdf
    return fn
