"""Evaluation: BLEU statistics (A7) and scores (A8, A9), masked cross-entropy (A10, A11),
greedy picks (O2), the score board (A14) and the evaluation report (C5, S10).

BLEU statistics are mergeable sums: every task counts the n-grams of its rows and clips them there
(Arrow batches, no n-gram leaves its row), and one sum of a dozen numbers per task ends it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.text import PAD_ID

MAX_ORDER = 4
SLICE_TOKENS = 200_000     # counted together in a task
LOG_ZERO = -9999999999.0   # log of a zero precision in the smoothed score (fixed value)


def ngrams(tokens: Column, n: int) -> Column:
    """Array of the ``n``-grams of a token array, each joined by a space."""
    size = F.size(tokens)
    return F.when(size >= n, F.transform(
        F.sequence(F.lit(0), size - n),
        lambda i: F.array_join(F.slice(tokens, i + 1, n), " ")
    )).otherwise(F.array().cast("array<string>"))


def clipped_counts(hyp: pa.ListArray, ref: pa.ListArray, max_order: int = MAX_ORDER) -> list[np.ndarray]:
    """Per row and order: matches clipped by the reference, n-grams of hyp, n-grams of ref (three arrays an order).

    Rows are counted together: tokens get a code, an n-gram's code comes from its (n-1)-gram's and its last token's, and
    the counts of (row, n-gram) of both sides are intersected sorted.  A row of which either side is null counts nothing."""
    rows = len(hyp)
    usable = np.logical_and(*(x.is_valid().to_numpy(zero_copy_only=False) for x in (hyp, ref)))
    lens = [np.where(usable, x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64) for x in (hyp, ref)]
    flat = [x.filter(pa.array(usable)).flatten() for x in (hyp, ref)]
    codes = pa.chunked_array([x.cast(pa.string()).fill_null("") for x in flat]).combine_chunks().dictionary_encode()
    token = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(codes.dictionary))
    every = np.concatenate(lens)
    ends = np.repeat(np.cumsum(every), every)                       # of the row side a token is in
    row = np.repeat(np.concatenate([np.arange(rows), np.arange(rows)]), every)
    first_ref = int(lens[0].sum())
    at, gram = np.arange(len(token)), token
    out = []
    for n in range(1, max_order + 1):
        if n > 1:
            keep = at + n <= ends[at]
            at, gram = at[keep], gram[keep]
            gram = np.unique(gram * size + token[at + n - 1], return_inverse=True)[1]
        wide = int(gram.max()) + 1 if len(gram) else 1
        key, hyp_side = row[at] * wide + gram, at < first_ref
        h, r = (np.unique(k, return_counts=True) for k in (key[hyp_side], key[~hyp_side]))
        both, i, j = np.intersect1d(h[0], r[0], assume_unique=True, return_indices=True)
        out.append(np.bincount(both // wide, np.minimum(h[1][i], r[1][j]), rows).astype(np.int64))
        out += [np.maximum(x - n + 1, 0) for x in lens]
    return out


def token_slices(hyp: pa.ListArray, ref: pa.ListArray, tokens: int = SLICE_TOKENS) -> Iterator[tuple[int, int]]:
    """(first row, rows) of slices of about ``tokens`` tokens, a row whole: the arrays of a slice do not grow with the rows of a batch."""
    size = sum(x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (hyp, ref))
    total, at = np.cumsum(size), 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + tokens, "right")))
        yield at, end - at
        at = end


def bleu_stats(df: DataFrame, hyp: str, ref: str, key: str = "pair_id",
               by: Sequence[str] = (), max_order: int = MAX_ORDER) -> DataFrame:
    """``[by...,] n, matches, total, ref_total`` (the n=1 totals are the two lengths).
    ``hyp``/``ref`` are token-array columns; one reference per row.  Counted inside the rows; the only exchange is that of
    the last sum, of a row a task, order and group."""
    names = [f"{s}{n}" for n in range(1, max_order + 1) for s in ("m", "t", "r")]
    tags = [f"_by{i}" for i in range(len(by))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, size in token_slices(b.column("h"), b.column("r")):
                part = b.slice(at, size)
                stats = clipped_counts(part.column("h"), part.column("r"), max_order)
                yield pa.RecordBatch.from_arrays([*(part.column(t) for t in tags), *(pa.array(x) for x in stats)],
                                                 names=[*tags, *names])

    rows = df.select(*(F.col(c).alias(t) for c, t in zip(by, tags)), F.col(hyp).cast("array<string>").alias("h"),
                     F.col(ref).cast("array<string>").alias("r"))
    schema = ", ".join([f"{t} {rows.schema[t].dataType.simpleString()}" for t in tags] + [f"{c} long" for c in names])
    orders = F.explode(F.array(*(F.struct(F.lit(n).alias("n"), F.col(f"m{n}").alias("matches"), F.col(f"t{n}").alias("total"),
                                          F.col(f"r{n}").alias("ref_total")) for n in range(1, max_order + 1))))
    stats = (rows.mapInArrow(run, schema).select(*(F.col(t).alias(c) for c, t in zip(by, tags)), orders.alias("x"))
             .groupBy(*by, F.col("x.n").alias("n"))
             .agg(*(F.sum(f"x.{c}").alias(c) for c in ("matches", "total", "ref_total"))))
    return stats.where((F.col("total") > 0) | (F.col("ref_total") > 0))


def _pivot_stats(stats: DataFrame, by: Sequence[str], max_order: int) -> DataFrame:
    """One row per group with m1..m4, t1..t4 and the lengths (unigram totals of each side)."""
    aggs = []
    for n in range(1, max_order + 1):
        aggs.append(F.sum(F.when(F.col("n") == n, F.col("matches")).otherwise(0)).alias(f"m{n}"))
        aggs.append(F.sum(F.when(F.col("n") == n, F.col("total")).otherwise(0)).alias(f"t{n}"))
    aggs += [F.sum(F.when(F.col("n") == 1, F.col("total")).otherwise(0)).alias("hyp_len"),
             F.sum(F.when(F.col("n") == 1, F.col("ref_total")).otherwise(0)).alias("ref_len")]
    return stats.groupBy(*by).agg(*aggs)


def brevity_penalty(h: Column, r: Column) -> Column:
    return F.when(h >= r, F.lit(1.0)).when(h > 0, F.exp(F.lit(1.0) - r / h)).otherwise(F.lit(0.0))


def corpus_bleu(stats: DataFrame, by: Sequence[str] = (), max_order: int = MAX_ORDER,
                smooth: str = "exp") -> DataFrame:
    """Corpus BLEU (0-100) from A7 with exponential smoothing (or ``smooth="none"``)."""
    p = _pivot_stats(stats, by, max_order)
    logs, zeros = [], F.lit(0)
    stop = F.lit(False)
    any_match = F.lit(False)
    for n in range(1, max_order + 1):
        m, t = F.col(f"m{n}"), F.col(f"t{n}")
        any_match = any_match | (m > 0)
        stop = stop | (t == 0)
        zeros = zeros + F.when(m == 0, 1).otherwise(0)
        if smooth == "exp":
            pn = F.when(m == 0, F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * t)) \
                .otherwise(F.lit(100.0) * m / t)
        else:
            pn = F.lit(100.0) * m / t
        logs.append(F.when(stop | (pn <= 0), F.lit(LOG_ZERO)).otherwise(F.log(pn)))
    mean_log = sum(logs[1:], logs[0]) / max_order
    bp = brevity_penalty(F.col("hyp_len").cast("double"), F.col("ref_len").cast("double"))
    score = F.when(~any_match, F.lit(0.0)).otherwise(bp * F.exp(mean_log))
    return p.select(*by, score.alias("bleu"), bp.alias("bp"),
                    F.col("hyp_len"), F.col("ref_len"))


def plain_bleu(stats: DataFrame, by: Sequence[str] = (), max_order: int = MAX_ORDER) -> DataFrame:
    """Unsmoothed BLEU on a 0-1 scale (0 when any order has no match)."""
    p = _pivot_stats(stats, by, max_order)
    lsum, ok = F.lit(0.0), F.lit(True)
    for n in range(1, max_order + 1):
        m, t = F.col(f"m{n}"), F.col(f"t{n}")
        ok = ok & (m > 0) & (t > 0)
        lsum = lsum + F.when((m > 0) & (t > 0), F.log(m / t)).otherwise(F.lit(0.0)) / max_order
    geo = F.when(ok, F.exp(lsum)).otherwise(F.lit(0.0))
    ratio = F.col("hyp_len").cast("double") / F.col("ref_len").cast("double")
    bp = F.when(ratio > 1.0, F.lit(1.0)).otherwise(F.exp(F.lit(1.0) - F.lit(1.0) / ratio))
    return p.select(*by, (geo * bp).alias("bleu"), ratio.alias("ratio"), "hyp_len", "ref_len")


# ---------------------------------------------------------------------------------------------
# Loss (A10, A11) and greedy picks (O2)
# ---------------------------------------------------------------------------------------------

def masked_loss(df: DataFrame, scores: str = "scores", label: str = "label",
                batch: str = "batch_id", pad: int = PAD_ID) -> DataFrame:
    """A10: mean cross-entropy per batch, rows whose label is the pad id left out."""
    kept = df.where(F.col(label) != pad)
    return kept.groupBy(batch).agg(F.avg(A.nll(scores, label)).alias("loss"),
                                   F.count(F.lit(1)).alias("n_rows"))


def eval_loss(batch_losses: DataFrame, weighting: str = "batch", by: Sequence[str] = ()) -> DataFrame:
    """Mean of batch means (``"batch"``, RNN/Transformer) or row-weighted (``"row"``, the
    trainer's); both reported, ``loss`` is the chosen one.  ``by`` gives one row per group, such as a split."""
    agg = batch_losses.groupBy(*by).agg(F.avg("loss").alias("loss_batch_mean"),
                           (F.sum(F.col("loss") * F.col("n_rows")) / F.sum("n_rows")).alias("loss_row_mean"),
                           F.count(F.lit(1)).alias("n_batches"))
    chosen = "loss_batch_mean" if weighting == "batch" else "loss_row_mean"
    return agg.withColumn("loss", F.col(chosen))


def greedy_pick_long(df: DataFrame, keys: Sequence[str], token: str = "token",
                     score: str = "score") -> DataFrame:
    """O2 (long form): arg-max token per key, ties to the lowest token id."""
    return df.groupBy(*keys).agg(
        F.max_by(F.col(token), F.struct(F.col(score), -F.col(token))).alias("pick"))


# ---------------------------------------------------------------------------------------------
# A14 score board, C5 evaluate
# ---------------------------------------------------------------------------------------------

def scoreboard(long: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    """``split, metric`` x one column per model, 4 decimals.  Pass ``models`` to skip the
    extra job that finds the pivot values (a bounded distinct otherwise)."""
    if models is None:
        from .encode import bounded_collect
        models = sorted(r[0] for r in bounded_collect(long.select("model").where("model is not null").distinct(), 10_000,
                                                       "model list"))
    return long.groupBy("split", "metric").pivot("model", list(models)).agg(
        F.round(F.first("value"), 4))


def evaluate(pred: DataFrame, ref: DataFrame, tokenize, key: str = "pair_id",
             by: Sequence[str] = (), losses: DataFrame | None = None, model: str = "model",
             weighting: str = "batch") -> DataFrame:
    """Predictions + references (joined by key, J2) -> BLEU (A7, A8) and, when given,
    the loss (A10 -> A11), as a long ``model, split, metric, value`` table (S10).  The loss is reported per split if
    ``losses`` has the column ``by[0]``, else once for ``all``."""
    keys = [key] if isinstance(key, str) else list(key)
    j = pred.join(ref, keys)
    toks = j.select(*keys, *by, tokenize(F.col("pred")).alias("h"), tokenize(F.col("ref")).alias("r"))
    b = corpus_bleu(bleu_stats(toks, "h", "r", key=key, by=by), by=by)
    split = F.col(by[0]) if by else F.lit("all")
    rows = b.select(F.lit(model).alias("model"), split.cast("string").alias("split"),
                    F.explode(F.array(
                        F.struct(F.lit("bleu").alias("metric"), F.col("bleu").alias("value")),
                        F.struct(F.lit("hyp_len").alias("metric"), F.col("hyp_len").cast("double").alias("value")),
                        F.struct(F.lit("ref_len").alias("metric"), F.col("ref_len").cast("double").alias("value")),
                    )).alias("m")).select("model", "split", "m.metric", "m.value")
    if losses is not None:
        own = [c for c in by[:1] if c in losses.columns]
        l = eval_loss(losses, weighting, own).select(
            F.lit(model).alias("model"), (F.col(own[0]).cast("string") if own else F.lit("all")).alias("split"),
            F.lit("loss").alias("metric"), F.col("loss").alias("value"))
        rows = rows.unionByName(l)
    return rows


def evaluate_ids(df: DataFrame, pred_ids: str, ref_ids: str, vocab: DataFrame, tokenize,
                 key: str = "pair_id", by: Sequence[str] = (), cut_eos: bool = False,
                 first_k: int | None = None, cleanup: bool = False,
                 losses: DataFrame | None = None, model: str = "model",
                 weighting: str = "batch") -> DataFrame:
    """C5 from ids: optional EOS cut of the predictions (F17, T16), optional first ``k`` rows per
    batch (W4, T17; needs ``split, batch_id, row_in_batch``), decode both sides with the
    vocabulary (J4, F18), optional clean-up of spaces (F19), then :func:`evaluate`."""
    from ..functions.text import cleanup_spaces
    from .encode import decode_ids
    rows = df
    if first_k is not None:
        rows = rows.where(F.col("row_in_batch") < first_k)
    if cut_eos:
        rows = rows.withColumn(pred_ids, A.cut_at_eos(F.col(pred_ids)))
    pred = decode_ids(rows.select(key, pred_ids), pred_ids, vocab, key=key, out="pred")
    ref = decode_ids(rows.select(key, ref_ids), ref_ids, vocab, key=key, out="ref")
    if cleanup:
        pred = pred.withColumn("pred", cleanup_spaces("pred"))
        ref = ref.withColumn("ref", cleanup_spaces("ref"))
    if by:
        pred = pred.join(rows.select(key, *by), key)
    return evaluate(pred, ref, tokenize, key=key, by=by, losses=losses, model=model,
                    weighting=weighting)


def bleu_formula_py(m: list[int], t: list[int], h: int, r: int) -> float:
    """A8 in plain Python (tests, hand goldens)."""
    if not any(m):
        return 0.0
    k, logs = 1.0, []
    stop = False
    for mn, tn in zip(m, t):
        if tn == 0 or stop:
            stop = True
            logs.append(LOG_ZERO)
            continue
        if mn == 0:
            k *= 2
            logs.append(math.log(100.0 / (k * tn)))
        else:
            logs.append(math.log(100.0 * mn / tn))
    bp = 1.0 if h >= r else (math.exp(1 - r / h) if h > 0 else 0.0)
    return bp * math.exp(sum(logs) / len(logs))
