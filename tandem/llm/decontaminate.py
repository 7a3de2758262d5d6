"""Benchmark decontamination (10): prefix-filtered set join on word shingles.

A window (``WINDOW`` consecutive item words; a shorter item is one window) occurs in a document only
if every shingle of the window does, so the necessary prefix of a window, its shingles ordered by
rarity in the documents, is its rarest shingle alone.  The join is on that shingle; the position of the
shingle in both gives the only possible start, length and position bounds drop starts outside the
document, and the words are compared exactly.

Before the join, documents keep only shingles that fall into a bitmap of ``SLOTS`` benchmark
shingle hashes.  The bitmap is the only thing sent to tasks and its size is fixed, whatever the number of
items; with many items it lets more shingles through, and the equi-join still decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import ALNUM_WORDS, Words, mix64, slices, split_words, written

WINDOW, SHINGLE = 13, 5
SLOTS = 1 << 22


def grams(word_hash: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, word positions in the slice) of all runs of n words inside one document."""
    size = len(word_hash) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.full(size, np.uint64(n * 0x9E3779B9), np.uint64)
    for k in range(n):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + word_hash[k: k + size], 0x5EED + k)
    end = np.repeat(doc[1:], np.diff(doc))[:size]
    at = np.flatnonzero(np.arange(size) + n <= end)
    return h[at], at


def item_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """One row per window occurrence: key, win (its words joined by blanks), n, toks (its shingles)."""
    kind = benchmark.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            w = split_words(b.column(text), ALNUM_WORDS)
            wh, words = w.hashes()[w.codes], w.uniq_bytes()
            rows: dict[str, list] = {"who": [], "win": [], "n": [], "toks": []}
            for d in range(b.num_rows):
                s, e = int(w.doc[d]), int(w.doc[d + 1])
                n = min(WINDOW, e - s)
                for at in range(s, e - n + 1 if n else s):
                    h, _ = grams(wh[at: at + n], np.array([0, n]), min(SHINGLE, n))
                    rows["who"].append(d)
                    rows["win"].append(b" ".join(words[c] for c in w.codes[at: at + n]).decode())
                    rows["n"].append(n)
                    rows["toks"].append(h.view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column(key).take(pa.array(rows["who"], pa.int64())), pa.array(rows["win"], pa.string()),
                 pa.array(rows["n"], pa.int32()), pa.array(rows["toks"], pa.list_(pa.int64()))],
                names=[key, "win", "n", "toks"])

    return benchmark.select(key, text).mapInArrow(run, f"{key} {kind}, win string, n int, toks array<long>")


def _document_hits(docs: DataFrame, slots: np.ndarray, lengths: list[int], key: str, text: str) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()
    spread = docs.sparkSession.sparkContext.broadcast(np.packbits(slots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        bits = np.unpackbits(spread.value).astype(bool)
        uid = TaskContext.get().partitionId() << 33
        for b in slices(batches, text):
            w = split_words(b.column(text), ALNUM_WORDS)
            wh = w.hashes()[w.codes]
            toks, poss = [], []
            for n in lengths:
                h, at = grams(wh, w.doc, n)
                ok = bits[(h % np.uint64(SLOTS)).astype(np.int64)]
                toks.append(h[ok])
                poss.append(at[ok])
            tok, pos = np.concatenate(toks), np.concatenate(poss)
            order = np.argsort(pos, kind="stable")
            tok, pos = tok[order], pos[order]
            bounds = np.searchsorted(pos, w.doc)
            some = np.diff(bounds) > 0
            local = pos - np.repeat(w.doc[:-1], np.diff(bounds))
            off = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid + np.arange(b.num_rows), pa.int64()), b.column(key), pa.array(w.counts()),
                 pa.ListArray.from_arrays(off, pa.array(local, pa.int64())),
                 pa.ListArray.from_arrays(off, pa.array(tok.view(np.int64))),
                 pa.array([t if s else None for t, s in zip(b.column(text), some)], pa.string())],
                names=["uid", key, "n_words", "pos", "tok", "kept_text"])
            uid += b.num_rows

    return docs.select(key, text).mapInArrow(
        run, f"uid long, {key} {kind}, n_words long, pos array<long>, tok array<long>, kept_text string")


def _verify(found: DataFrame) -> DataFrame:
    """found: uid, kept_text, cand array<struct<start, win>> -> uid, n_hit, wins (those that occur)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                w: Words = split_words(b.column("kept_text").slice(i, 1), ALNUM_WORDS)
                words = w.uniq_bytes()
                hit, wins = np.zeros(len(w.codes), bool), set()
                for c in b.column("cand")[i].as_py():
                    want = c["win"].encode().split(b" ")
                    s, e = c["start"], c["start"] + len(want)
                    if [words[k] for k in w.codes[s:e]] == want:
                        hit[s:e] = True
                        wins.add(c["win"])
                yield pa.RecordBatch.from_arrays(
                    [b.column("uid").slice(i, 1), pa.array([int(hit.sum())], pa.int64()),
                     pa.array([sorted(wins)], pa.list_(pa.string()))], names=["uid", "n_hit", "wins"])

    return found.mapInArrow(run, "uid long, n_hit long, wins array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id") -> DataFrame:
    """Per row of ``docs``: key, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words; repeated rows give repeated rows; items without words have no window;
    items of the same text all count; items with a null id mark words but are not listed; an empty benchmark hits
    nothing.  Other columns are not read.
    """
    bench = written(item_windows(benchmark, item_key), "windows")
    lengths = sorted(r[0] for r in bench.select(F.least("n", F.lit(SHINGLE))).distinct().collect())
    slots = np.zeros(SLOTS, bool)
    used = bench.select(F.explode("toks").alias("t")).select(
        F.expr(f"t & {SLOTS - 1}").cast("int").alias("s")).distinct()
    slots[np.asarray(used.toPandas()["s"], np.int64)] = True      # at most SLOTS rows
    hits = written(_document_hits(docs, slots, lengths or [SHINGLE], key, text), "hits")
    occ = (hits.where(F.size("tok") > 0)
           .select("uid", "n_words", F.explode(F.arrays_zip("pos", "tok")).alias("o"))
           .select("uid", "n_words", "o.pos", "o.tok"))
    wins = bench.select("win", "n", "toks").dropDuplicates(["win"])
    ranked = wins.select("win", "n", F.posexplode("toks").alias("off", "tok"))
    df = occ.join(ranked.select("tok").distinct(), "tok", "left_semi").groupBy("tok").agg(
        F.count("*").alias("df"))
    prefix = (ranked.join(df, "tok", "left").groupBy("win", "n")
              .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "tok", "off")).alias("p"))
              .where("p.df > 0").select("win", "n", "p.tok", "p.off"))
    cand = (occ.join(prefix, "tok").withColumn("start", F.col("pos") - F.col("off"))
            .where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
            .groupBy("uid").agg(F.collect_list(F.struct("start", "win")).alias("cand")))
    checked = written(_verify(hits.select("uid", "kept_text").join(cand, "uid")), "verified")
    items = (checked.select("uid", F.explode("wins").alias("win"))
             .join(bench.select("win", F.col(item_key).cast("string").alias("item")), "win")
             .where("item is not null").groupBy("uid").agg(F.array_sort(F.collect_set("item")).alias("items")))
    got = checked.select("uid", "n_hit").join(items, "uid", "left")
    zero = F.array().cast("array<string>")
    out = hits.select("uid", key, "n_words").join(got, "uid", "left").select(
        key, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", zero).alias("items"))
    return out.select(
        key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"))
