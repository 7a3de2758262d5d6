"""Byte-pair encoding: pair counts (A3), best pair (O3), merge learning (A4), encoding
and the per-language tokenizer pipelines (X6).

Training keeps the word table ``(syms array<int>, c bigint)`` distributed, and learns many merges a
round.  A round takes the first ``candidates`` pairs in merge order and indexes them: every word is cut into its
runs, the stretches whose neighbours form candidate pairs, and equal runs are counted together.  All
occurrences of a candidate pair, and of every pair with a symbol that its merges create, lie in runs (next to a
run such a pair is at most as frequent as an old pair that is no candidate), so the merges found on the run
counts are the exact next ones for as long as they come before the first pair that is no candidate.
Only runs come back to the driver, and only if they are few; otherwise the round takes fewer candidates, in the end one,
which needs no runs.  The merges of a round are applied to the word table in one pass that touches the runs only.

Rules (T12): specials get ids 0-3, the alphabet follows in code-point order, merges are appended;
the next merge is the pair with the highest count, ties to the lowest (left id, right id); pairs
seen once are merged; a merge whose string is a token already takes that token's id; training stops at the
vocabulary size or when no pair is left.
"""

from __future__ import annotations

import functools
import heapq
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (BYTE_TO_CHAR, SPACE_KIND, SPECIALS, UNK_ID, WordCutter, byte_pieces, bytes_to_symbols,
                              char_classes, is_ascii, normalize, normalize_fast, pretok_bytes, pretok_words, symbols_to_text)
from ..session import drop_path, scratch_path
from .encode import HASH_BASE, PartEncoder, _buffers, bounded_collect, sized_broadcast, spread, words_at
from .vocab import CHAR_PATTERN

VOCAB_SIZE = 30_000
WORDS_PER_TASK = 25_000
CANDIDATES = 32_768          # pairs a round may choose from
FIRST = 64                   # and those of the first round
MAX_RUNS = 100_000           # distinct runs a round may bring to the driver,
MAX_SYMBOLS = 2_000_000      # and their symbols
LONG_WORD = 64               # symbols from which a word is merged through a heap
MERGE_SYMBOLS = 1 << 17      # of the words that are merged together
CACHE_WORDS = 200_000        # runs a task keeps with what they become
INLINE_ALPHABET = 4096      # alphabets up to this size are mapped to ids with a literal map
MARKS = [chr(0xFDD0 + i) for i in range(len(SPECIALS))]      # non-characters
SPARE_MARK = chr(0xFDD0 + len(SPECIALS))


# ---------------------------------------------------------------------------------------------
# Per-language pipelines
# ---------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class TextPipeline:
    lang: str
    normalize: callable
    pretokenize: callable
    decode: callable


def _decode_words(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def _decode_bytes(tokens: Column) -> Column:
    return symbols_to_text(F.array_join(tokens, ""))


def tokenizer_for(lang: str) -> TextPipeline:
    """``en`` -> words (F4), ``zh`` -> byte level (F5, F6); both normalised by F2."""
    if lang == "en":
        return TextPipeline("en", normalize, pretok_words, _decode_words)
    if lang == "zh":
        return TextPipeline("zh", normalize, pretok_bytes, _decode_bytes)
    raise ValueError(f"unknown lang {lang}")


# ---------------------------------------------------------------------------------------------
# A3 / O3
# ---------------------------------------------------------------------------------------------

def adjacent_pairs(syms: Column) -> Column:
    """Array of ``struct(a, b)`` for every adjacent position (overlaps included)."""
    n = F.size(syms)
    return F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 2),
                                     lambda i: F.struct(syms[i].alias("a"), syms[i + 1].alias("b"))))


def pair_counts(words: DataFrame, syms: str = "syms", count: str = "c") -> DataFrame:
    """A3: ``a, b, count``: adjacent pairs weighted by the word count.  Hot pairs are absorbed by
    the map-side partial sum before the shuffle."""
    return (words.select(F.explode(adjacent_pairs(F.col(syms))).alias("p"), F.col(count))
            .groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b"))
            .agg(F.sum(count).alias("count")))


def best_pairs(counts: DataFrame, k: int = 1) -> DataFrame:
    """O3: top-``k`` pairs by count desc, then left, then right (TakeOrdered, no full sort)."""
    return counts.orderBy(F.desc("count"), F.asc("a"), F.asc("b")).limit(k)


# ---------------------------------------------------------------------------------------------
# A4: learning the merges
# ---------------------------------------------------------------------------------------------

def merge_pair(syms: Column, a: int, b: int, new: int) -> Column:
    """Left-to-right, non-overlapping replacement of ``(a, b)`` by ``new`` inside the array."""
    empty = F.array().cast("array<int>")

    def step(acc, x):
        hit = (F.size(acc) > 0) & (F.element_at(acc, -1) == F.lit(a)) & (x == F.lit(b))
        return F.when(hit, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.lit(new)))) \
            .otherwise(F.concat(acc, F.array(x)))

    touched = F.array_contains(syms, a) & F.array_contains(syms, b)
    return F.when(touched, F.aggregate(syms, empty, step)).otherwise(syms)


@dataclass
class BpeModel:
    """Tokenizer model as tables: ``vocab(token, id)`` and ``merges(rank, left, right)``; the
    driver copies are bounded by the vocabulary size."""
    lang: str
    tokens: list[str]                               # id -> token
    merges: list[tuple[int, int, int]] = field(default_factory=list)   # (left id, right id, new id)
    rounds: int = 0                                 # Spark rounds used by training

    def vocab_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(zip(self.tokens, range(len(self.tokens)))),
                                     "token string, id int")

    def merges_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(r, self.tokens[a], self.tokens[b]) for r, (a, b, _) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string")

    @classmethod
    def from_frames(cls, lang: str, vocab: DataFrame, merges: DataFrame | None) -> "BpeModel":
        toks = sorted((r["id"], r["token"]) for r in bounded_collect(vocab, what="vocabulary"))
        tokens = [t for _, t in toks]
        ids = {t: i for i, t in enumerate(tokens)}
        ms = []
        if merges is not None:
            for r in sorted(bounded_collect(merges, what="merges"), key=lambda r: r["rank"]):
                ms.append((ids[r["left"]], ids[r["right"]], ids[r["left"] + r["right"]]))
        return cls(lang, tokens, ms)


def training_words(df: DataFrame, text: str, lang: str) -> DataFrame:
    """``word, c``: pre-tokenised words of the normalised text with their counts (A1).

    No word crosses a space, so texts are cut at their spaces first, which needs no regular expression, and what lies between is
    normalised and cut into words once a distinct part.  At byte level that holds for a space before a visible character, so only
    ASCII texts whose spaces are single and inside go this way, the others whole."""
    p, c = tokenizer_for(lang), F.col(text)
    if lang == "zh":
        other = functools.reduce(lambda a, b: a | b, [c.contains(x) for x in ("  ", "\t", "\n", "\x0b", "\f", "\r")])
        whole = ~is_ascii(c) | other | c.startswith(" ") | c.endswith(" ") | (c == "")
        pieces = lambda x: byte_pieces(p.normalize(x))
    else:
        whole, pieces = F.lit(False), lambda x: p.pretokenize(p.normalize(x))
    parts = (df.select(F.explode(F.when(whole, F.array(c)).otherwise(F.split(c, " ", -1))).alias("part"))
             .groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    counted = (parts.select(F.explode(pieces(F.col("part"))).alias("word"), "n")
               .groupBy("word").agg(F.sum("n").alias("c")))
    return counted.select(bytes_to_symbols("word").alias("word"), "c") if lang == "zh" else counted


def initial_words(word_counts: DataFrame) -> tuple[list[str], DataFrame]:
    """Alphabet (A2, bounded by distinct code points, brought to the driver) and the word table
    with character ids."""
    chars = F.regexp_extract_all(F.col("word"), F.lit(CHAR_PATTERN), 0)
    alpha = sorted(r[0] for r in bounded_collect(
        word_counts.select(F.explode(chars).alias("ch")).distinct(), what="alphabet"))
    tokens = list(SPECIALS) + alpha
    if not alpha:
        return tokens, word_counts.select("word", "c", F.array().cast("array<int>").alias("syms"))
    if len(alpha) <= INLINE_ALPHABET:
        # a small alphabet (byte level: at most 256 symbols) is a literal map: ids are looked up
        # inside the row, no explode, join or regroup
        lookup = F.create_map(*[x for i, ch in enumerate(alpha)
                                for x in (F.lit(ch), F.lit(i + len(SPECIALS)))])
        return tokens, word_counts.select(
            "word", "c", F.transform(chars, lambda ch: lookup[ch]).alias("syms"))
    alpha_df = word_counts.sparkSession.createDataFrame(
        [(ch, i + len(SPECIALS)) for i, ch in enumerate(alpha)], "ch string, cid int")
    exploded = word_counts.select("word", "c", F.posexplode(chars).alias("pos", "ch"))
    joined = exploded.join(sized_broadcast(alpha_df), "ch")
    words = joined.groupBy("word", "c").agg(
        F.sort_array(F.collect_list(F.struct("pos", "cid"))).alias("s")) \
        .select("word", "c", F.transform("s", lambda x: x["cid"]).alias("syms"))
    return tokens, words


def _code(a: int, b: int) -> int:
    return a << 32 | b


def merge_symbols(syms: list[int], table: dict[int, tuple[int, int]]) -> list[int]:
    """Apply merges ``pair code -> (rank, new id)`` to one word: lowest rank first, leftmost first."""
    if len(syms) > LONG_WORD:
        return _merge_long(syms, table)
    while len(syms) > 1:
        hits = [(hit[0], i, hit[1]) for i in range(len(syms) - 1)
                if (hit := table.get(syms[i] << 32 | syms[i + 1])) is not None]
        if not hits:
            break
        rank, _, new = min(hits)
        at = {i for r, i, _ in hits if r == rank}
        out, i = [], 0
        while i < len(syms):
            if i in at:
                out.append(new)
                i += 2
            else:
                out.append(syms[i])
                i += 1
        syms = out
    return syms


def _merge_long(syms: list[int], table: dict[int, tuple[int, int]]) -> list[int]:
    """The same for a long word in n log n: a heap of (rank, place) over a linked list."""
    syms, n = list(syms), len(syms)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(hit[0], i, syms[i], syms[i + 1]) for i in range(n - 1)
            if (hit := table.get(syms[i] << 32 | syms[i + 1])) is not None]
    heapq.heapify(heap)

    def push(i: int, j: int) -> None:
        hit = table.get(syms[i] << 32 | syms[j])
        if hit is not None:
            heapq.heappush(heap, (hit[0], i, syms[i], syms[j]))

    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i]
        if syms[i] != a or j >= n or syms[j] != b:
            continue                                   # one of the two was merged meanwhile
        syms[i], syms[j] = table[a << 32 | b][1], -1
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
            push(i, right[j])
        if left[i] >= 0:
            push(left[i], i)
    return [x for x in syms if x >= 0]


class _Words:
    """The words of one Arrow batch, flat; ``codes`` is the pair that starts at a place, -1 at the end of a word."""

    def __init__(self, batch: pa.RecordBatch):
        col = batch.column("syms")
        self.lens = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.weight = batch.column("c").to_numpy()
        self.word = np.repeat(np.arange(len(self.lens)), self.lens)
        self.codes = np.full(len(self.flat), -1, np.int64)
        self.codes[:-1] = self.flat[:-1] << 32 | self.flat[1:]
        self.codes[np.cumsum(self.lens)[self.lens > 0] - 1] = -1

    def runs(self, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first place, number of symbols) of every run; ``candidates`` are sorted codes."""
        at = np.minimum(np.searchsorted(candidates, self.codes), len(candidates) - 1)
        linked = np.concatenate([[False], candidates[at] == self.codes, [False]])
        first = np.flatnonzero(linked[1:] & ~linked[:-1])
        return first, np.flatnonzero(linked[:-1] & ~linked[1:]) - first + 1


def _spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(starts[i], starts[i] + lens[i])``."""
    return np.arange(int(lens.sum())) + np.repeat(starts - (np.cumsum(lens) - lens), lens)


def _lists(flat: np.ndarray, lens: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def coded_pair_counts(words: DataFrame) -> DataFrame:
    """A3 on pair codes (``left << 32 | right``): ``pair, count``, summed per batch before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = _Words(b)
            at = np.flatnonzero(w.codes >= 0)
            pair, inverse = np.unique(w.codes[at], return_inverse=True)
            n = np.zeros(len(pair), np.int64)
            np.add.at(n, inverse, w.weight[w.word[at]])
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    return words.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("count"))


def run_counts(words: DataFrame, candidates: np.ndarray) -> DataFrame:
    """``run, c``: the runs of the candidate pairs with their counts, equal runs together."""
    sent = words.sparkSession.sparkContext.broadcast(np.sort(candidates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = _Words(b)
            first, lens = w.runs(sent.value)
            yield pa.RecordBatch.from_arrays(
                [_lists(w.flat[_spread(first, lens)], lens), pa.array(w.weight[w.word[first]])], names=["run", "c"])

    return words.mapInArrow(run, "run array<int>, c long").groupBy("run").agg(F.sum("c").alias("c"))


def merged_words(words: DataFrame, candidates: np.ndarray, merges: list[tuple[int, int, int]]) -> DataFrame:
    """The word table after the merges of a round, without the words that became one symbol; only runs are rewritten, equal
    ones once a task."""
    table = {_code(a, b): (rank, new) for rank, (a, b, new) in reversed(list(enumerate(merges)))}
    sent = words.sparkSession.sparkContext.broadcast((np.sort(candidates), table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ranks = sent.value
        known: dict[bytes, np.ndarray] = {}
        for b in batches:
            w = _Words(b)
            first, lens = w.runs(codes)
            parts = []
            for i, n in zip(first.tolist(), lens.tolist()):
                piece = w.flat[i: i + n]
                key = piece.tobytes()
                got = known.get(key)
                if got is None:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    got = known[key] = np.array(merge_symbols(piece.tolist(), ranks), np.int64)
                parts.append(got)
            size = np.array([len(x) for x in parts], np.int64)
            kept = np.ones(len(w.flat), np.int64)          # symbols that a place becomes
            kept[_spread(first, lens)] = 0
            stays = np.flatnonzero(kept)
            kept[first] = size
            to = np.cumsum(kept) - kept
            out = np.empty(int(kept.sum()), np.int64)
            out[to[stays]] = w.flat[stays]
            if parts:
                out[_spread(to[first], size)] = np.concatenate(parts)
            lens = np.bincount(w.word, kept, len(w.lens)).astype(np.int64)
            more = lens > 1                                 # a word of one symbol has no pair any more
            yield pa.RecordBatch.from_arrays(
                [_lists(out[np.repeat(more, lens)], lens[more]), pa.array(w.weight[more])], names=["syms", "c"])

    return words.select("syms", "c").mapInArrow(run, "syms array<int>, c long")


def merges_from_runs(runs: list[list[int]], weights: list[int], bound: tuple[int, int, int] | None, tokens: list[str],
                     ids: dict[str, int], limit: int) -> list[tuple[int, int, int]]:
    """The next merges that come before ``bound`` = (-count, left, right), at most ``limit`` new tokens; ``tokens`` and ``ids``
    are extended.  Counts are updated in the runs that hold the merged pair.  A merge into a token that is there
    already is the last: its pairs may also occur outside the runs."""
    counts: dict[tuple[int, int], int] = defaultdict(int)
    where: dict[tuple[int, int], set[int]] = defaultdict(set)

    def put(i: int, sign: int, seen: set) -> None:
        for pair in zip(runs[i], runs[i][1:]):
            counts[pair] += sign * weights[i]
            seen.add(pair)
            if sign > 0:
                where[pair].add(i)

    for i in range(len(runs)):
        put(i, 1, set())
    heap = [(-n, *pair) for pair, n in counts.items()]
    heapq.heapify(heap)
    merges: list[tuple[int, int, int]] = []
    goal = len(tokens) + limit
    while heap and len(tokens) < goal:
        top = heapq.heappop(heap)
        pair = top[1:]
        if not top[0] or counts[pair] != -top[0]:
            continue                                   # out of date; its count was pushed when it changed
        if bound is not None and top >= bound:
            break
        name = tokens[pair[0]] + tokens[pair[1]]
        again = name in ids
        if not again:
            ids[name] = len(tokens)
            tokens.append(name)
        merges.append((*pair, ids[name]))
        if again:
            break
        table, changed = {_code(*pair): (0, ids[name])}, set()
        for i in where.pop(pair):
            if pair in zip(runs[i], runs[i][1:]):
                put(i, -1, changed)
                runs[i] = merge_symbols(runs[i], table)
                put(i, 1, changed)
        for other in changed:
            if counts[other]:
                heapq.heappush(heap, (-counts[other], *other))
    return merges


def _write_words(words: DataFrame) -> tuple[DataFrame, str]:
    spark = words.sparkSession
    path = scratch_path(spark, "bpe-words")
    words.write.parquet(path)
    return spark.read.schema("syms array<int>, c long").parquet(path), path


def train_bpe(df: DataFrame, text: str, lang: str, vocab_size: int = VOCAB_SIZE,
              num_merges: int | None = None, candidates: int = CANDIDATES) -> BpeModel:
    """A4: learn merges until ``vocab_size`` entries (or ``num_merges`` merges) or no pair is left.

    Per round: count pairs, take the first ``candidates`` (a quarter of them while there are more than ``MAX_RUNS`` runs), collect
    their runs, find the next merges, rewrite the word table below the shared folder.  The result does not depend on
    ``candidates``; 1 is one merge a round.
    """
    spark = df.sparkSession
    counted = training_words(df, text, lang).persist(StorageLevel.MEMORY_AND_DISK)
    tokens, words = initial_words(counted)
    tasks = max(1, -(-counted.count() // WORDS_PER_TASK))
    words, path = _write_words(words.select("syms", "c").repartition(tasks))
    counted.unpersist()
    model = BpeModel(lang, tokens)
    ids = {t: i for i, t in enumerate(tokens)}
    target = vocab_size if num_merges is None else len(tokens) + num_merges
    k = max(1, min(candidates, FIRST))
    while len(tokens) < target:
        top = coded_pair_counts(words).orderBy(F.desc("count"), "pair").limit(k + 1).collect()
        if not top:
            break
        order = [(-r["count"], r["pair"] >> 32, r["pair"] & 0xFFFFFFFF) for r in top]
        merges: list[tuple[int, int, int]] = []
        while not merges:
            codes = np.array([r["pair"] for r in top[:k]], np.int64)
            if k == 1:
                _, a, b = order[0]
                merges = merges_from_runs([[a, b]], [1], None, tokens, ids, 1)
                break
            runs = run_counts(words, codes).persist(StorageLevel.MEMORY_AND_DISK)
            size = runs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("run")).alias("symbols")).first()
            few = size["n"] <= MAX_RUNS and (size["symbols"] or 0) <= MAX_SYMBOLS
            if few:
                found = runs.toArrow()
                merges = merges_from_runs(found["run"].to_pylist(), found["c"].to_pylist(),
                                          order[k] if len(order) > k else None, tokens, ids, target - len(tokens))
            runs.unpersist()
            if not few:
                k = max(1, k // 4)
                continue
        model.merges += merges
        model.rounds += 1
        if len(tokens) < target:
            last = path
            words, path = _write_words(merged_words(words, codes, merges))
            drop_path(spark, last)
        if k == 1 or size["n"] * 4 < MAX_RUNS:
            k = min(candidates, (16 if k > 1 and size["n"] * 16 < MAX_RUNS else 4) * k)
    drop_path(spark, path)
    return model


# ---------------------------------------------------------------------------------------------
# encoding
# ---------------------------------------------------------------------------------------------

class MergeTable:
    """The merges of a model as flat arrays: the merges of many short words are found together, those of long ones word by word."""

    def __init__(self, merges: Sequence[tuple[int, int, int]]):
        self.ranks = {_code(a, b): r for r, (a, b, _) in enumerate(merges)}
        self.new = np.array([new for _, _, new in merges], np.int64)
        self.none = len(merges)                         # the rank of a pair that is not merged
        self.shift = np.uint64(64 - max(4, (8 * len(merges)).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), -1, np.int64)      # open addressing
        self.values = np.full(len(self.keys), self.none, np.int64)
        pairs = np.fromiter(self.ranks, np.int64, len(self.ranks))
        for pair, rank, at in zip(pairs.tolist(), self.ranks.values(), self._places(pairs).tolist()):
            while self.keys[at] >= 0:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.values[at] = pair, rank

    def _places(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(HASH_BASE) >> self.shift).astype(np.int64)

    @functools.cached_property
    def table(self) -> dict[int, tuple[int, int]]:
        return {c: (r, int(self.new[r])) for c, r in self.ranks.items()}

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left << 32 | right
        at = self._places(pairs)
        key = self.keys[at]
        out = np.where(key == pairs, self.values[at], self.none)
        live = np.flatnonzero((key != pairs) & (key >= 0))
        at = at[live]
        while len(live):                                # the place is taken by another pair
            at = (at + 1) % len(self.keys)
            key = self.keys[at]
            same = key == pairs[live]
            out[live[same]] = self.values[at[same]]
            more = ~same & (key >= 0)
            live, at = live[more], at[more]
        return out

    def merge(self, flat: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:func:`merge_symbols` of words that lie one after another, ``lens`` symbols each; some at a time, so that their
        arrays stay in the processor's cache."""
        ends = np.concatenate([[0], np.cumsum(lens)])
        out, at = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        while at < len(lens):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + MERGE_SYMBOLS, "right")) - 1)
            if lens[at] > LONG_WORD:
                syms = np.array(merge_symbols(flat[ends[at]: ends[at + 1]].tolist(), self.table), np.int64)
                out.append((syms, np.array([len(syms)])))
                at += 1
                continue
            long = np.flatnonzero(lens[at: to] > LONG_WORD)
            to = at + int(long[0]) if len(long) else to
            out.append(self._merge_block(flat[ends[at]: ends[to]], lens[at: to]))
            at = to
        return np.concatenate([f for f, _ in out]), np.concatenate([n for _, n in out])

    def _merge_block(self, flat: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = flat.astype(np.int64)
        word = np.repeat(np.arange(len(lens)), lens)
        done = []                                       # (words, their symbols)
        rank = np.full(len(flat), self.none, np.int64)  # of the pair that begins at a place
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.ranks_of(flat[inner], flat[inner + 1])
        while len(flat):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(first, len(flat)))
            low = np.minimum.reduceat(rank, first)
            live = low < self.none
            if not live.all():
                keep = np.repeat(live, size)
                done.append((word[~keep], flat[~keep]))
                flat, word, rank, low, size = flat[keep], word[keep], rank[keep], low[live], size[live]
            hit = rank == np.repeat(low, size)           # the pairs of the lowest rank of their word
            if (hit[1:] & hit[:-1]).any():               # aaa: every other place, from the left
                at = np.flatnonzero(hit)
                new_run = np.concatenate([[True], np.diff(at) != 1])
                hit[at] = (at - at[new_run][np.cumsum(new_run) - 1]) % 2 == 0
            at = np.flatnonzero(hit)
            flat[at] = self.new[rank[at]]
            keep = np.ones(len(flat), bool)
            keep[at + 1] = False
            flat, word, rank = flat[keep], word[keep], rank[keep]
            at -= np.arange(len(at))                     # where the merged symbols are now
            near = np.concatenate([at, at[at > 0] - 1])
            rank[near] = self.none
            near = near[near + 1 < len(flat)]
            near = near[word[near] == word[near + 1]]
            rank[near] = self.ranks_of(flat[near], flat[near + 1])
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(lens), np.int64)
        word = np.concatenate([w for w, _ in done])
        return np.concatenate([s for _, s in done])[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(lens))


class BpeEncoder(PartEncoder):
    """F7 of texts in a worker: special strings marked, text normalised, cut into words, words merged.

    A word never crosses a space, so a text is encoded part by part between its spaces.  At byte level that holds if every
    space stands between visible characters and no special string is there; other texts are one part."""

    def __init__(self, model: BpeModel, classes: bytes):
        super().__init__()
        self.bytes, self.merges = model.lang == "zh", MergeTable(model.merges)
        chars = {t: i for i, t in enumerate(model.tokens) if i >= len(SPECIALS) and len(t) == 1}
        self.known = np.array(sorted(map(ord, chars)), np.uint32)
        self.chars = np.array([chars[chr(c)] for c in self.known.tolist()] or [UNK_ID], np.int64)
        self.of_byte = np.array([chars.get(c, UNK_ID) for c in BYTE_TO_CHAR], np.int64)
        self.cut = WordCutter(model.lang, classes)
        spaces = "".join(f"\\x{{{c:x}}}" for c in self.cut.spaces if c != 0x20)
        self.odd = f"[{spaces}\\x{{{ord(MARKS[0]):x}}}-\\x{{{ord(SPARE_MARK):x}}}]|{'|'.join(SPECIALS)}|  |^ | $|^$"

    def whole(self, texts: pa.Array) -> np.ndarray:
        if not self.bytes:
            return np.zeros(len(texts), bool)
        return pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)

    def words(self, text: str) -> list[str]:
        """The words of a text; special strings are words of one mark."""
        plain = normalize_fast(_marked(text))
        if plain.isascii() or not any(m in plain for m in MARKS):
            return self.cut(plain)
        return [w for s in _SEGMENTS.findall(plain) for w in ([s] if s in MARKS else self.cut(s))]

    def parts(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The same of many parts at once: words, their number in each part, and whether nothing is left of a part.  Parts are cut
        where the class of a character changes; at byte level the space before a part belongs to its first word."""
        if not texts:
            return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, bool)
        plain = normalize_fast(_marked(" " + " ".join(texts)))
        codes = np.frombuffer(plain.encode("utf-32-le"), np.uint32)
        kind = self.cut.kinds[codes]
        begins = np.concatenate([[True], kind[1:] != kind[:-1]])
        space = codes == 0x20
        if self.bytes:
            begins[1:] &= ~space[:-1]
            begins |= space
            self._contractions(codes, kind, begins, space)
        else:
            begins |= (codes >= ord(MARKS[0])) & (codes <= ord(MARKS[-1]))
            begins |= space
            begins[1:] |= (codes[:-1] >= ord(MARKS[0])) & (codes[:-1] <= ord(MARKS[-1]))
        at = np.flatnonzero(begins)
        words = words_at(plain, codes, at)
        part = np.cumsum(space)[at] - 1
        if self.bytes:
            return words, np.bincount(part, minlength=len(texts)), np.diff(np.append(np.flatnonzero(space), len(codes))) == 1
        real = kind[at] != SPACE_KIND
        return words.filter(pa.array(real)), np.bincount(part[real], minlength=len(texts)), np.zeros(len(texts), bool)

    def _contractions(self, codes: np.ndarray, kind: np.ndarray, begins: np.ndarray, space: np.ndarray) -> None:
        """'s, 't, 're, 've, 'm, 'll, 'd behind a letter or number are words; what follows is another."""
        text = np.concatenate([codes, [0x20, 0x20]])
        at = np.flatnonzero(begins & (codes == ord("'")) & ~space)
        one, two = text[at + 1], text[at + 2]
        size = np.isin(one, [*map(ord, "stmd")]).astype(np.int64)
        for pair in ("re", "ve", "ll"):
            size[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
        at, size = at[size > 0], size[size > 0]
        begins[at + 1] = False
        after = at + 1 + size
        begins[after[after < len(begins)]] = True

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slow = np.zeros(len(texts), bool)
        if self.bytes:
            column = pa.array(texts, pa.string())
            slow = self.whole(column) | pc.match_substring(column, " ").to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(~slow), np.flatnonzero(slow)])
        fast, counts, gone = self.parts([texts[i] for i in order[:len(texts) - slow.sum()].tolist()])
        cut = [self.words(texts[i]) for i in np.flatnonzero(slow).tolist()]
        more = pa.array([w.encode() for ws in cut for w in ws], pa.binary())
        counts = np.concatenate([counts, np.fromiter(map(len, cut), np.int64, len(cut))])
        coded = pa.concat_arrays([_MARK_BYTES, fast, more]).dictionary_encode()     # a word that is a special string is its id
        words = coded.indices.to_numpy(zero_copy_only=False)[len(MARKS):]
        flat, lens = self._merged(coded.dictionary.slice(len(MARKS)))
        flat, lens = np.concatenate([np.arange(len(MARKS)), flat]), np.concatenate([np.ones(len(MARKS), np.int64), lens])
        sizes = lens[words]
        total = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        flat = flat[spread((np.cumsum(lens) - lens)[words], sizes)]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        sizes = np.diff(total)[back]
        return flat[spread(total[:-1][back], sizes)], sizes, np.concatenate([gone, np.zeros(len(cut), bool)])[back]

    def _merged(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ends, raw = _buffers(words)
        raw, ends = raw[ends[0]: ends[-1]], ends.astype(np.int64) - ends[0]
        if self.bytes:
            return self.merges.merge(self.of_byte[raw], np.diff(ends))
        codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        place = np.searchsorted(self.known, codes)
        place[place == len(self.known)] = 0
        known = self.known[place] == codes if len(self.known) else np.zeros(len(codes), bool)
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[ends]
        return self.merges.merge(np.where(known, self.chars[place], UNK_ID), np.diff(chars))


def _marked(text: str) -> str:
    """Special strings as one mark each (T11), before the text is normalised; marks in the text itself become a
    further code point, which no vocabulary has."""
    if not text.isascii():
        text = text.translate(_SPARED) if any(m in text for m in MARKS) else text
    if "<" in text:
        for special, mark in zip(SPECIALS, MARKS):
            text = text.replace(special, mark)
    return text


_SPARED = str.maketrans(dict.fromkeys(MARKS, SPARE_MARK))
_SEGMENTS = re.compile(f"[{''.join(MARKS)}]|[^{''.join(MARKS)}]+")
_MARK_BYTES = pa.array([m.encode() for m in MARKS], pa.binary())


_KEPT: dict[str, BpeEncoder] = {}
ENCODERS = 2                 # a worker process keeps: those of both sides


def _encoder(name: str, sent: Broadcast) -> BpeEncoder:
    """The encoder of a model, with what it has encoded, once a worker process."""
    if name not in _KEPT:
        while len(_KEPT) >= ENCODERS:
            _KEPT.pop(next(iter(_KEPT)))
        lang, tokens, merges, classes = sent.value
        _KEPT[name] = BpeEncoder(BpeModel(lang, tokens, merges), classes)
    return _KEPT[name]


def _encoder_udf(spark: SparkSession, model: BpeModel):
    """Texts -> ids."""
    bc = spark.sparkContext.broadcast((model.lang, model.tokens, model.merges, char_classes(spark)))
    name = uuid.uuid4().hex

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def enc_rows(texts: pa.Array) -> pa.Array:
        return _encoder(name, bc)(texts)

    return enc_rows


def bpe_encode(df: DataFrame, text: str, model: BpeModel, key: str | Sequence[str] = "pair_id",
               out: str = "ids") -> DataFrame:
    """sentence -> ids; ``key`` is the column or columns carried along.

    Rows are encoded where they lie by one Arrow UDF (:class:`BpeEncoder`) -- the input is read once, there is no shuffle, so no
    hot word."""
    keys = [key] if isinstance(key, str) else list(key)
    enc_rows = _encoder_udf(df.sparkSession, model)
    return df.select(*keys, enc_rows(F.make_valid_utf8(F.coalesce(F.col(text), F.lit("")))).alias(out))


def token_strings(spark: SparkSession, model: BpeModel, ids: str) -> Column:
    """The tokens of an id array joined without a separator; the token list is looked up in the worker."""
    bc = spark.sparkContext.broadcast(model.tokens)

    @F.pandas_udf(T.StringType())
    def join(rows: pd.Series) -> pd.Series:
        tokens = bc.value
        return rows.map(lambda xs: "".join([tokens[i] for i in xs]))
    return join(F.col(ids))


def bpe_decode(df: DataFrame, ids: str, model: BpeModel, key: str = "pair_id",
               out: str = "text") -> DataFrame:
    """F18 for BPE models: specials skipped, words joined by a space (``en``) or bytes decoded
    (``zh``)."""
    from .encode import decode_ids
    spark = df.sparkSession
    if model.lang == "en":
        return decode_ids(df, ids, model.vocab_frame(spark), key=key, out=out)
    joined = decode_ids(df, ids, model.vocab_frame(spark), key=key, out="_t", sep="")
    return joined.select(key, symbols_to_text(F.col("_t")).alias(out))
