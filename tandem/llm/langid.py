"""Language ID (4): multilingual mixture inference.

Training counts byte trigrams of words (with word-edge marks) per language over all training rows;
counts are summed in tasks first and the model is languages x ``SLOTS`` numbers, whatever the input
size.  A document is a mixture of languages: expectation-maximisation estimates its proportions from the
likelihood of each word under each language.  The nested language sets "the k languages of largest
proportion" are refitted and the set of largest log-likelihood minus
``PENALTY / 2 * k * ln(words)`` is kept; its largest member is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import ALNUM_WORDS, Words, segment_sum, slices, split_words, text_bytes

SLOTS = 1 << 15
ADD = 0.5
PENALTY = 2.0
ROUNDS, REFIT_ROUNDS = 6, 4
UNKNOWN = "und"


def trigram_slots(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(slot of every trigram of every distinct word, bounds per word); a word of m bytes between edge
    marks has m trigrams."""
    data, off = text_bytes(w.uniq)
    lens = np.diff(off)
    n = len(lens)
    marked = np.zeros(len(data) + 2 * n, np.uint64)
    place = np.arange(len(data)) + 1 + 2 * np.repeat(np.arange(n), lens)
    marked[place] = data
    at = np.arange(len(data)) + 2 * np.repeat(np.arange(n), lens)
    if len(at) == 0:
        return np.zeros(0, np.int64), off
    code = (marked[at] << np.uint64(16)) | (marked[at + 1] << np.uint64(8)) | marked[at + 2]
    slot = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)
    return slot.astype(np.int64), off


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """(sorted languages, log-probabilities [languages, SLOTS]) from all rows with a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in slices(batches, text):
            w = split_words(b.column(text), ALNUM_WORDS)
            slot, off = trigram_slots(w)
            enc = b.column(lang).dictionary_encode()
            of_doc = enc.indices.to_numpy(zero_copy_only=False)
            of_word = np.repeat(of_doc, w.counts())
            for k, name in enumerate(enc.dictionary.to_pylist()):
                times = np.bincount(w.codes[of_word == k], minlength=len(w.uniq))
                got = np.bincount(slot, weights=np.repeat(times, np.diff(off)), minlength=SLOTS)
                total[name] = total.get(name, 0) + got
        for name, got in total.items():
            at = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()),
                 pa.array(got[at].astype(np.int64))], names=["lang", "slot", "n"])

    counts = (docs.where(F.col(lang).isNotNull()).select(text, F.col(lang).alias(lang))
              .mapInArrow(run, "lang string, slot int, n long")
              .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counts["lang"].unique())
    table = np.zeros((len(langs), SLOTS))
    table[np.searchsorted(langs, counts["lang"]) if langs else [], counts["slot"]] = counts["n"]
    used = max(1, int((table.sum(axis=0) > 0).sum()))
    return langs, np.log((table + ADD) / (table.sum(axis=1, keepdims=True) + ADD * (used + 1)))


def _mixture(like: np.ndarray, doc: np.ndarray, owner: np.ndarray, theta: np.ndarray,
             rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM from ``theta``: (proportions, log-likelihood beyond the word constants) per document."""
    n = np.maximum(np.diff(doc), 1)[:, None]
    full = np.flatnonzero(np.diff(doc))
    for _ in range(rounds):
        part = theta[owner] * like
        part /= part.sum(axis=1, keepdims=True)
        new = np.zeros_like(theta)
        if len(full):
            new[full] = np.add.reduceat(part, doc[full], axis=0)
        theta = new / n
    fit = np.log(np.maximum((theta[owner] * like).sum(axis=1), 1e-300))
    return theta, segment_sum(fit.astype(np.float64), doc)


def infer(w: Words, table: np.ndarray) -> np.ndarray:
    """Language proportions per document within its selected set (rows sum to 1; 0 without words)."""
    langs = len(table)
    slot, off = trigram_slots(w)
    logp = np.stack([segment_sum(row[slot], off) for row in table], axis=1) if langs else np.zeros((len(w.uniq), 0))
    per = np.exp(np.maximum(logp - logp.max(axis=1, keepdims=True), -60.0)).astype(np.float32)
    like, owner = per[w.codes], np.repeat(np.arange(len(w.doc) - 1), w.counts())
    theta = np.full((len(w.doc) - 1, langs), 1.0 / langs, np.float32)
    theta, fit = _mixture(like, w.doc, owner, theta, ROUNDS)
    size = np.log(np.maximum(w.counts(), 2))
    best, best_value = theta, fit - PENALTY / 2 * langs * size
    order = np.argsort(-theta, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    for k in range(langs - 1, 0, -1):
        start = np.where(rank < k, np.maximum(theta, 1e-6), 0).astype(np.float32)
        start /= start.sum(axis=1, keepdims=True)
        got, fit = _mixture(like, w.doc, owner, start, REFIT_ROUNDS if k > 1 else 1)
        value = fit - PENALTY / 2 * k * size
        better = value >= best_value
        best = np.where(better[:, None], got, best)
        best_value = np.where(better, value, best_value)
    best[w.counts() == 0] = 0
    return best


def identify(docs: DataFrame, langs: list[str], table: np.ndarray, key: str = "doc_id", text: str = "text",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: key, the ``carry`` columns, lang_pred (``und`` if text is null, has no letter, or
    nothing was learned), score (proportion of lang_pred in the mixture, 0 for ``und``), mixture
    ("lang:proportion" of the selected set).  Ties go to the first language in order.  Repeated
    rows give repeated rows."""
    kept = docs.select(*dict.fromkeys([key, text, *carry]))
    fields = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in (key, *carry))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            letters = pc.match_substring_regex(b.column(text), r"\p{L}").to_numpy(zero_copy_only=False)
            pred, score, mix = [], [], []
            if langs:
                w = split_words(b.column(text), ALNUM_WORDS)
                theta = infer(w, table)
            for d in range(b.num_rows):
                if not langs or not letters[d] or not theta[d].any():
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    mix.append("")
                    continue
                t = theta[d]
                top = int(t.argmax())
                pred.append(langs[top])
                score.append(min(1.0, float(t[top])))
                mix.append(",".join(f"{langs[k]}:{t[k]:.3f}" for k in np.flatnonzero(t > 0)))
            yield pa.RecordBatch.from_arrays(
                [b.column(key), *(b.column(c) for c in carry), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64()), pa.array(mix, pa.string())],
                names=[key, *carry, "lang_pred", "score", "mixture"])

    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double, mixture string")
