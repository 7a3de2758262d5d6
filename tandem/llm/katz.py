"""LM scoring (2): Katz backoff bigrams with Good-Turing discounts and exactly normalised weights.

Work is done on chunks (about ``CHUNK_TOKENS`` tokens of whole documents), so that what is shuffled is
distinct words and word pairs of a chunk, as packed columns, never single tokens:

1. chunks: token codes, distinct words (64-bit hashes) and their training counts; written as a table
   bucketed by chunk, which later steps join without shuffling it.
2. words: counts meet by hash bucket.  The unigram table is written; every chunk gets back number
   and count of its words.
3. pairs: the distinct (history, word) pairs of a chunk meet by history (histories of more than
   HOT occurrences are split by word).  The bigram table is written; every chunk gets back the count of
   its pairs and, per history, the numbers of continuations seen 1..K times and the unigram mass of
   all its continuations.
4. scoring: per token, P(w|h) = d_c c(hw) / c(h) if the pair was seen, else alpha(h) P(w).

Good-Turing (both orders): d_r = (r*/r - A) / (1 - A), A = (K+1) n_{K+1} / n_1, for r <= K; the
largest K <= 5 whose discounts all lie in (0, 1) is used.  alpha(h) gives the discounted mass to the
words unseen after h in proportion to P(w), so the probabilities after every history sum to 1 over
the known words and one unknown word.  A history without discounted mass counts once more
(denominator c(h) + 1), so nothing has probability 0.  The unknown word has the unigrams' discounted mass.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import SPACE_WORDS, mix64, partitions, segment_sum, slices, split_words, written
from tandem.session import scratch_path

CHUNK_TOKENS = 1_000_000
HOT = 4_000_000
K = 5
END = np.uint64(1)           # hash of the end token; words of that hash do not occur in practice
HISTORY_BEGIN = 0            # number of the begin mark as a history; word numbers start at 1


def pack(a: np.ndarray) -> bytes:
    """Integers in the narrowest width, bytes grouped by significance, compressed."""
    a = np.ascontiguousarray(a)
    if a.dtype.kind in "iu":
        top = int(a.max(initial=0))
        a = a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
                     if top < 1 << 32 else np.uint64)
    planes = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return a.dtype.char.encode() + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(raw: bytes) -> np.ndarray:
    kind = np.dtype(raw[:1].decode())
    planes = zstandard.ZstdDecompressor().decompress(raw[1:])
    a = np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).ravel()
    return a.astype(np.int64) if kind.kind in "iu" else a


def discounts(n: list[int]) -> np.ndarray:
    """d[r] for r = 0..K (d[0] unused) from n[r-1] = number of types seen r times, r = 1..K+1; all
    ones if no K works."""
    for k in range(K, 0, -1):
        if min(n[: k + 1]) <= 0:
            continue
        a = (k + 1) * n[k] / n[0]
        d = np.ones(K + 1)
        for r in range(1, k + 1):
            d[r] = ((r + 1) * n[r] / (r * n[r - 1]) - a) / (1 - a) if a != 1 else 0.0
        if all(0 < x < 1 for x in d[1: k + 1]):
            return d
    return np.ones(K + 1)


@dataclass
class Unigrams:
    """P(w) from a count; ``p(0)`` is the unknown word."""

    tokens: int
    types: int
    d: np.ndarray
    den: float
    unknown: float

    @classmethod
    def fit(cls, tokens: int, types: int, n: list[int]) -> Unigrams:
        d = discounts(n)
        left = sum((1 - d[r]) * r * n[r - 1] for r in range(1, K + 1))
        if left > 0:
            return cls(tokens, types, d, float(tokens), left / tokens)
        return cls(tokens, types, d, tokens + 1.0, 1 / (tokens + 1.0))

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.d[np.where(c <= K, c, 0)] * c / self.den, self.unknown)


def _chunk_rows(docs: DataFrame, key: str, text: str, held: str, kind: str, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 32
        keys, helds, lens, hashes, codes, held_tokens = [], [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            n, is_held = np.concatenate(lens), np.concatenate(helds)
            uniq, inv = np.unique(np.concatenate(hashes), return_inverse=True)
            at = np.cumsum([0, *(len(h) for h in hashes[:-1])])
            code = np.concatenate([inv[a + c] for a, c in zip(at, codes)])
            often = np.bincount(code, minlength=len(uniq))
            order = np.argsort(-often, kind="stable")
            new = np.empty(len(uniq), np.int64)
            new[order] = np.arange(len(uniq))
            code = new[code]
            train = np.bincount(code[~np.repeat(is_held, n)], minlength=len(uniq))
            all_keys = pa.concat_arrays(keys)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(all_keys)], pa.int32()), all_keys),
                 pa.array([pack(is_held.view(np.uint8))], pa.binary()), pa.array([pack(n)], pa.binary()),
                 pa.array([pack(code)], pa.binary()), pa.array([pack(uniq[order])], pa.binary()),
                 pa.array([pack(train)], pa.binary()), pa.array([int((~is_held).sum())], pa.int64())],
                names=["chunk", "keys", "held", "lens", "codes", "words", "trained", "train_docs"])

        for b in slices(batches, text):
            w = split_words(b.column(text), SPACE_WORDS)
            n, end = w.counts(), len(w.uniq)
            full = np.full(len(w.codes) + len(n), end, np.int64)
            full[np.arange(len(w.codes)) + np.repeat(np.arange(len(n)), n)] = w.codes
            keys.append(b.column(key))
            helds.append(b.column(held).to_numpy(zero_copy_only=False).astype(bool))
            lens.append(n + 1)
            hashes.append(np.append(w.hashes(), END))
            codes.append(full)
            held_tokens += len(full)
            if held_tokens >= size:
                yield flush()
                chunk, held_tokens = chunk + 1, 0
                keys, helds, lens, hashes, codes = [], [], [], [], []
        if keys:
            yield flush()

    return docs.select(key, text, held).mapInArrow(
        run, f"chunk long, keys array<{kind}>, held binary, lens binary, codes binary, words binary, "
        "trained binary, train_docs long")


def _groups(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions in order) of every non-empty bucket."""
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(n + 1))
    for k in np.flatnonzero(np.diff(bounds)):
        yield int(k), order[bounds[k]: bounds[k + 1]]


def _word_requests(chunks: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                words, trained = unpack(b.column("words")[i].as_py()).astype(np.uint64), unpack(b.column("trained")[i].as_py())
                rows = [(k, pack(words[at]), pack(trained[at]))
                        for k, at in _groups((words % np.uint64(n)).astype(np.int64), n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()),
                     pa.array([b.column("chunk")[i].as_py()] * len(rows), pa.int64()),
                     pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                    names=["bucket", "chunk", "words", "trained"])

    return chunks.select("chunk", "words", "trained").mapInArrow(
        run, "bucket int, chunk long, words binary, trained binary")


_WORDS = "bucket int, chunk long, a binary, b binary, tokens long, types long, seen array<long>"


def _seen(total: np.ndarray) -> list[int]:
    return [int((total == r).sum()) for r in range(1, K + 2)]


def _count_words(n: int):
    """Rows with chunk null are the table (hashes, counts); the others answer a chunk (numbers,
    counts).  Numbers follow the count within a bucket, so frequent words have small ones."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        bucket = t["bucket"][0].as_py()
        words = [unpack(x.as_py()).astype(np.uint64) for x in t["words"]]
        counts = np.concatenate([unpack(x.as_py()) for x in t["trained"]])
        uniq, inv = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(inv, weights=counts, minlength=len(uniq)).astype(np.int64)
        order = np.argsort(-total, kind="stable")
        number = np.empty(len(uniq), np.int64)
        number[order] = np.arange(len(uniq)) * n + bucket + 1
        number[total == 0] = 0
        rows = [(bucket, None, pack(uniq[total > 0]), pack(total[total > 0]), int(total.sum()),
                 int((total > 0).sum()), _seen(total))]
        ends = np.cumsum([0, *(len(w) for w in words)])
        for k, chunk in enumerate(t["chunk"].to_pylist()):
            at = inv[ends[k]: ends[k + 1]]
            rows.append((bucket, chunk, pack(number[at]), pack(total[at]), 0, 0, [0] * (K + 1)))
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.table([pa.array(c, ty) for c, ty in zip(zip(*rows), types)],
                        names=["bucket", "chunk", "a", "b", "tokens", "types", "seen"])

    return run


def _answers(table: DataFrame, fields: list[str], name: str) -> DataFrame:
    """All answers to a chunk in one row (at most one per bucket)."""
    return (table.where("chunk is not null").groupBy("chunk")
            .agg(F.collect_list(F.struct("bucket", *fields)).alias(name)))


def _word_facts(row: dict, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, numbers, training counts) of a chunk's distinct words."""
    words = unpack(row["words"]).astype(np.uint64)
    number, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    got = {x["bucket"]: x for x in row["word_answers"]}
    for k, at in _groups((words % np.uint64(n)).astype(np.int64), n):
        number[at], count[at] = unpack(got[k]["a"]), unpack(got[k]["b"])
    return words, number, count


def _token_pairs(row: dict, words: np.ndarray,
                 number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, history codes, distinct pair keys, pair of each token or -1) of the tokens after a
    known history; the begin mark is history code len(number).  An unknown word stands as the end token
    here: its own probability needs the facts of its history only."""
    codes, lens = unpack(row["codes"]), unpack(row["lens"])
    begin, end = len(number), int(np.flatnonzero(words == END)[0])
    prev = np.empty_like(codes)
    prev[1:] = codes[:-1]
    prev[np.cumsum(lens) - lens] = begin
    known = np.append(number > 0, True) & (number[end] > 0)
    use = known[prev]
    word = np.where(known[codes], codes, end)
    keys, inv = np.unique(prev[use] * (begin + 1) + word[use], return_inverse=True)
    pair = np.full(len(codes), -1, np.int64)
    pair[use] = inv
    return codes, prev, keys, pair


def _pair_layout(keys: np.ndarray, number: np.ndarray, count: np.ndarray, begins: int, hot: int,
                 n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[tuple[int, np.ndarray]]]:
    """History numbers, word numbers, word counts of the pairs, and their buckets; the positions of a bucket
    are ordered by (history, word)."""
    size = len(number) + 1
    hist, word = keys // size, keys % size
    h = np.append(number, HISTORY_BEGIN)[hist]
    w, cw = number[word], count[word]
    pieces = np.append(count, begins)[hist] // hot + 1
    part = mix64(w.astype(np.uint64), 77) % pieces.astype(np.uint64)
    bucket = (mix64(h.astype(np.uint64) ^ (part << np.uint64(40)), 99) % np.uint64(n)).astype(np.int64)
    order = np.lexsort((w, h, bucket))
    bounds = np.searchsorted(bucket[order], np.arange(n + 1))
    groups = ((int(k), order[bounds[k]: bounds[k + 1]]) for k in np.flatnonzero(np.diff(bounds)))
    return h, w, cw, groups


def _runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[starts], np.diff(np.append(starts, len(h)))


def _pair_requests(joined: DataFrame, n: int, begins: int, hot: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in b.schema.names}
                words, number, count = _word_facts(row, n)
                codes, _, keys, pair = _token_pairs(row, words, number)
                train = ~np.repeat(unpack(row["held"]).astype(bool), unpack(row["lens"])) & (pair >= 0)
                times = np.bincount(pair[train], minlength=len(keys))
                h, w, cw, groups = _pair_layout(keys, number, count, begins, hot, n)
                rows = []
                for k, at in groups:
                    hs, runs = _runs(h[at])
                    rows.append((k, row["chunk"], pack(hs), pack(runs), pack(w[at]), pack(cw[at]), pack(times[at])))
                types = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
                cols = zip(*rows) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    names=["bucket", "chunk", "h", "runs", "w", "cw", "times"])

    return joined.mapInArrow(
        run, "bucket int, chunk long, h binary, runs binary, w binary, cw binary, times binary")


_PAIRS = ("bucket int, chunk long, h binary, runs binary, w binary, counts binary, few binary, mass binary, "
          "types long, seen array<long>")


def _count_pairs(uni: Unigrams):
    """Rows with chunk null are the bigram table; the others answer a chunk: counts of its pairs and, per
    history of its request, few = continuations seen 1..K times (flat), mass = sum of P(w) over all
    continuations in this bucket."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        bucket = t["bucket"][0].as_py()
        heads = [unpack(x.as_py()) for x in t["h"]]
        h = np.concatenate([np.repeat(a, unpack(r.as_py())) for a, r in zip(heads, t["runs"])])
        w = np.concatenate([unpack(x.as_py()) for x in t["w"]])
        cw = np.concatenate([unpack(x.as_py()) for x in t["cw"]])
        times = np.concatenate([unpack(x.as_py()) for x in t["times"]])
        hu, hi = np.unique(h, return_inverse=True)
        wu, wi = np.unique(w, return_inverse=True)
        ku, first, ki = np.unique(hi * max(1, len(wu)) + wi, return_index=True, return_inverse=True)
        total = np.bincount(ki, weights=times, minlength=len(ku)).astype(np.int64)
        seen = total > 0
        of_h = (ku // max(1, len(wu)))[seen]
        got = total[seen]
        mass = np.bincount(of_h, weights=uni.p(cw[first][seen]), minlength=len(hu))
        few = np.zeros((len(hu), K), np.int64)
        low = got <= K
        np.add.at(few, (of_h[low], got[low] - 1), 1)
        hs, runs = _runs(hu[of_h])
        rows = [(bucket, None, pack(hs), pack(runs), pack(wu[(ku % max(1, len(wu)))[seen]]), pack(got), b"", b"",
                 int(seen.sum()), _seen(got))]
        ends = np.cumsum([0, *(len(unpack(x.as_py())) for x in t["w"])])
        for k, chunk in enumerate(t["chunk"].to_pylist()):
            at = np.searchsorted(hu, heads[k])
            rows.append((bucket, chunk, b"", b"", b"", pack(total[ki[ends[k]: ends[k + 1]]]), pack(few[at].ravel()),
                         pack(mass[at]), 0, [0] * (K + 1)))
        types = [pa.int32(), pa.int64(), *[pa.binary()] * 6, pa.int64(), pa.list_(pa.int64())]
        return pa.table([pa.array(c, ty) for c, ty in zip(zip(*rows), types)],
                        names=["bucket", "chunk", "h", "runs", "w", "counts", "few", "mass", "types", "seen"])

    return run


def _split_histories(pairs: DataFrame, words: DataFrame, n: int, hot: int, begins: int,
                     uni: Unigrams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, few, mass) of the histories whose pairs were split, from the tables: at most
    tokens / hot + 1 of them, summed with partial aggregation."""
    table = words.where("chunk is null").select("bucket", "b").mapInArrow(_numbered(n), "w long, cw long")
    wanted = np.array(sorted(r[0] for r in table.where(F.col("cw") >= hot).select("w").collect()), np.int64)
    if begins >= hot:
        wanted = np.append([HISTORY_BEGIN], wanted)
    if len(wanted) == 0:
        return wanted, np.zeros((0, K)), np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                h = np.repeat(unpack(b.column("h")[i].as_py()), unpack(b.column("runs")[i].as_py()))
                at = np.flatnonzero(np.isin(h, wanted))
                w, c = unpack(b.column("w")[i].as_py())[at], unpack(b.column("counts")[i].as_py())[at]
                yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(w), pa.array(c)], names=["h", "w", "c"])

    of_hot = pairs.where("chunk is null").select("h", "runs", "w", "counts").mapInArrow(run, "h long, w long, c long")
    d = F.element_at(F.array(*(F.lit(float(x)) for x in uni.d[1:])), F.least("cw", F.lit(K)).cast("int"))
    p = F.when(F.col("cw") <= K, d).otherwise(1.0) * F.col("cw") / uni.den
    got = (of_hot.join(table, "w").groupBy("h")
           .agg(*(F.sum((F.col("c") == r).cast("long")).alias(f"n{r}") for r in range(1, K + 1)),
                F.sum(p).alias("mass")).orderBy("h").toPandas())
    return (got["h"].to_numpy(np.int64), got[[f"n{r}" for r in range(1, K + 1)]].to_numpy(float),
            got["mass"].to_numpy(float))


def _numbered(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                total = unpack(b.column("b")[i].as_py())
                order = np.argsort(-total, kind="stable")
                number = np.empty(len(total), np.int64)
                number[order] = np.arange(len(total)) * n + b.column("bucket")[i].as_py() + 1
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(total)], names=["w", "cw"])
    return run


def _score(joined: DataFrame, key: str, kind: str, n: int, hot: int, uni: Unigrams, d2: np.ndarray,
           train_docs: int, split: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    base_den = math.log10(uni.tokens + 0.1 * (uni.types + 1))
    split_h, split_few, split_mass = split
    left_of = np.array([(1 - d2[r]) * r for r in range(1, K + 1)])
    split_left = split_few @ left_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in b.schema.names if c != "keys"}
                words, number, count = _word_facts(row, n)
                codes, prev, keys, pair = _token_pairs(row, words, number)
                h, _, _, groups = _pair_layout(keys, number, count, train_docs, hot, n)
                got = {x["bucket"]: x for x in row["pair_answers"] or []}
                total = np.zeros(len(keys), np.int64)
                left, mass = np.zeros(len(keys)), np.zeros(len(keys))
                for k, at in groups:
                    total[at] = unpack(got[k]["counts"])
                    _, runs = _runs(h[at])
                    left[at] = np.repeat(unpack(got[k]["few"]).reshape(-1, K) @ left_of, runs)
                    mass[at] = np.repeat(unpack(got[k]["mass"]), runs)
                at = np.minimum(np.searchsorted(split_h, h), max(0, len(split_h) - 1))
                hit = np.flatnonzero(split_h[at] == h) if len(split_h) else []
                if len(hit):
                    left[hit], mass[hit] = split_left[at[hit]], split_mass[at[hit]]
                size = len(number) + 1
                hist = keys // size
                ch = np.append(count, train_docs)[hist].astype(float)
                none = left <= 0
                den = np.where(none, ch + 1, ch)
                p_pair = d2[np.where(total <= K, total, 0)] * total / den
                alpha = np.where(none, 1.0, left) / den / (1 - mass)
                p_word = uni.p(count)
                back = np.log10(p_word)
                log_alpha = np.zeros(size)          # unknown histories: 1
                log_alpha[hist] = np.log10(alpha)
                pair_log = np.log10(np.where(total > 0, p_pair, 1.0))
                back_off = back[codes] + log_alpha[prev]
                if len(keys):
                    seen = (pair >= 0) & (count[codes] > 0) & (total[pair] > 0)
                    value = np.where(seen, pair_log[pair], back_off)
                else:
                    value = back_off
                bounds = np.concatenate([[0], np.cumsum(unpack(row["lens"]))])
                base = np.log10(count + 0.1) - base_den
                yield pa.RecordBatch.from_arrays(
                    [b.column("keys")[i].values, pa.array(unpack(row["held"]).astype(bool)),
                     pa.array(np.diff(bounds)), pa.array(segment_sum((count > 0).astype(np.int64)[codes], bounds)),
                     pa.array(segment_sum(base[codes], bounds)), pa.array(segment_sum(value, bounds))],
                    names=[key, "held_out", "n_tokens", "n_known", "base_score", "score"])

    return joined.mapInArrow(run, f"{key} {kind}, held_out boolean, n_tokens long, n_known long, "
                             "base_score double, score double")


def _bucketed(df: DataFrame, n: int, name: str) -> DataFrame:
    """Written table with n buckets by chunk: later joins on chunk read it where it lies."""
    table = f"tandem_{name}_{uuid.uuid4().hex[:12]}"
    (df.write.bucketBy(n, "chunk").sortBy("chunk").option("path", scratch_path(df.sparkSession, name))
     .option("compression", "none").saveAsTable(table))
    return df.sparkSession.table(table)


def _sums(table: DataFrame, *fields: str) -> list[int]:
    row = table.where("chunk is null").agg(
        *(F.sum(f) for f in fields), *(F.sum(F.col("seen")[r]) for r in range(K + 1))).first()
    return [int(x or 0) for x in row]


def katz_scores(docs: DataFrame, held: str, key: str = "doc_id", text: str = "text",
                chunk_tokens: int = CHUNK_TOKENS, hot: int = HOT) -> DataFrame:
    """Learn from the rows whose boolean column ``held`` is false, score all rows.

    Tokens: ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, then one end token.  Per row: key,
    held_out, n_tokens, n_known, train_tokens, base_score (additive 0.1 unigram model), score (log10
    probability of the text).  Null and empty texts are the end token alone; repeated rows count and are
    returned as often as they occur; without training rows every token is the unknown word
    (score 0).  Other columns are not read.
    """
    spark = docs.sparkSession
    n, kind = partitions(spark), docs.schema[key].dataType.simpleString()
    chunks = _bucketed(_chunk_rows(docs, key, text, held, kind, chunk_tokens), n, "katz_chunks")
    train_docs = int(chunks.agg(F.sum("train_docs")).first()[0] or 0)
    words = written(_word_requests(chunks, n).groupBy("bucket").applyInArrow(_count_words(n), _WORDS), "katz_words")
    tokens, types, *seen = _sums(words, "tokens", "types")
    uni = Unigrams.fit(tokens, types, seen)
    hot = max(hot, tokens >> 16)
    joined = chunks.join(_answers(words, ["a", "b"], "word_answers"), "chunk")
    pairs = written(_pair_requests(joined, n, train_docs, hot).groupBy("bucket")
                    .applyInArrow(_count_pairs(uni), _PAIRS), "katz_pairs")
    _, *seen = _sums(pairs, "types")
    split = _split_histories(pairs, words, n, hot, train_docs, uni)
    joined = joined.join(_answers(pairs, ["counts", "few", "mass"], "pair_answers"), "chunk", "left")
    out = _score(joined, key, kind, n, hot, uni, discounts(seen), train_docs, split)
    return out.withColumn("train_tokens", F.lit(tokens).cast("long")).select(
        key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
