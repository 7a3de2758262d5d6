"""Token <-> id: word-id lookup (J3), id -> token decode (J4, F18), and the size-checked broadcast
used by every vocabulary join.

A vocabulary of up to ``SHIP_BYTES`` (checked before it is brought over) is sent to the workers as flat arrays (sorted hashes for lookups, so a
worker holds no more than the vocabulary itself), and
rows are looked up where they lie, a batch at a time: no explode, no shuffle, so no hot token.  A larger one is
joined by shuffle: tokens are exploded and salted by their place, the vocabulary has a copy per salt, so a token that
holds a third of all places is dealt to many tasks; rows are put together again by their key.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPECIALS, UNK_ID

# Vocabularies up to this many rows are broadcast (30k-token models are ~1 MB); bigger ones are
# joined by shuffle.  The size is counted before the plan is chosen.
BROADCAST_MAX_ROWS = 2_000_000
SHIP_BYTES = 256 << 20       # vocabularies up to this size go to the workers whole
SALTS = 16


def sized_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(small)`` only after checking its row count; the frame itself otherwise."""
    small = small.persist()          # counted once, then read from the cache by the join
    n = small.count()
    return F.broadcast(small) if n <= max_rows else small


def bounded_collect(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, what: str = "table"):
    """Rows of a reference table (vocabulary, dictionary, alphabet) for the driver, refusing
    anything larger than ``max_rows`` -- corpus-sized data never comes back."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows; too large to bring to the driver")
    return rows


def _regroup(df: DataFrame, key: str, pos: str, value: Column, out: str) -> DataFrame:
    items = F.collect_list(F.when(F.col(pos).isNotNull(), F.struct(F.col(pos).alias("p"),
                                                                    value.alias("v"))))
    return df.groupBy(key).agg(F.sort_array(items).alias("_s")).select(
        key, F.transform("_s", lambda x: x["v"]).alias(out))


def collected(vocab: DataFrame, max_bytes: int, token: str = "token", more: Sequence[str] = (), descending: bool = False) -> pa.Table | None:
    """``token``, ``id`` and ``more`` columns of a vocabulary by id as an Arrow table, or None if it is larger than ``max_bytes``."""
    rows = vocab.select(F.col(token).alias("token"), F.col("id").cast("long").alias("id"), *more).persist()
    size = rows.agg(F.sum(F.octet_length("token") + 16 + 8 * len(more))).first()[0] or 0
    table = rows.orderBy(F.desc("id") if descending else F.asc("id")).toArrow() if size <= max_bytes else None
    rows.unpersist()
    return table


def _one(column: pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    return (pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)).cast(kind)


def shipped(vocab: DataFrame, max_bytes: int = SHIP_BYTES) -> Broadcast | None:
    """(tokens, ids) of a vocabulary by ascending id, or None if it is larger than ``max_bytes``."""
    table = collected(vocab, max_bytes)
    if table is None:
        return None
    return vocab.sparkSession.sparkContext.broadcast((_one(table["token"], pa.string()), _one(table["id"], pa.int64())))


def shipped_index(vocab: DataFrame, max_bytes: int = SHIP_BYTES) -> Broadcast | None:
    """A :class:`TokenIndex` of a vocabulary, or None if it is larger than ``max_bytes``."""
    table = collected(vocab, max_bytes)
    return None if table is None else vocab.sparkSession.sparkContext.broadcast(TokenIndex.of(table))


HASH_BASE = 0x9E3779B97F4A7C15                    # odd, so it has an inverse modulo 2^64
HASH_MIX = 0xBF58476D1CE4E5B9                     # spreads what differs in few digits
HASH_UNBASE = pow(HASH_BASE, -1, 1 << 64)
HASHED_WORDS = 65_536                            # words hashed at a time


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(starts[i], starts[i] + lens[i])``."""
    return np.arange(int(lens.sum())) + np.repeat(starts - (np.cumsum(lens) - lens), lens)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def part_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of every stretch ``data[starts[i]:ends[i]]``, from one pass over ``data``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(HASH_BASE, len(data))[:-1], dtype=np.uint64, out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(HASH_UNBASE, len(data))[starts]


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array."""
    if not len(words):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset: words.offset + len(words) + 1]
    return ends, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


@dataclass
class TokenIndex:
    """A vocabulary as flat arrays in the order of its tokens' hashes: 16 bytes a token besides its text, and nothing is built from it to look
    tokens up.  Of equal tokens the first counts."""
    hashes: np.ndarray
    ends: np.ndarray            # where a token's bytes begin, and end with the next
    data: np.ndarray
    ids: np.ndarray
    null_id: int | None = None
    scores: np.ndarray | None = None

    @classmethod
    def of(cls, table: pa.Table, score: str | None = None) -> "TokenIndex":
        words, ids = _one(table["token"], pa.string()), _one(table["id"], pa.int32()).to_numpy(zero_copy_only=False)
        absent = words.is_null().to_numpy(zero_copy_only=False)
        parts = []
        for at in range(0, len(words), HASHED_WORDS):
            ends, data = _buffers(words[at: at + HASHED_WORDS])
            parts.append(part_hashes(data[ends[0]: ends[-1]], ends[:-1] - ends[0], ends[1:] - ends[0]))
        hashes = np.concatenate([*parts, np.zeros(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        order = order[~absent[order]]
        ends, data = _buffers(words.take(pa.array(order)))
        scores = None if score is None else _one(table[score], pa.float64()).to_numpy(zero_copy_only=False)[order]
        return cls(hashes[order], ends, data, ids[order], int(ids[absent][0]) if absent.any() else None, scores)

    @functools.cached_property
    def _bits(self) -> np.ndarray:
        """A bit for the first digits of every hash, 16 to 32 bits a token; made where it is used."""
        bits = np.zeros(1 << max(3, (16 * len(self.hashes)).bit_length()), bool)
        bits[self._digits(self.hashes, len(bits))] = True
        return np.packbits(bits, bitorder="little")

    @staticmethod
    def _digits(hashes: np.ndarray, n: int) -> np.ndarray:
        return ((hashes * np.uint64(HASH_MIX)) >> np.uint64(65 - n.bit_length())).astype(np.int64)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rare: bool = False) -> np.ndarray:
        """Places of the tokens ``data[starts[i]:ends[i]]``, -1 for those that are none; with ``rare``, if most are none, those are told
        by one look at a small table."""
        found = np.full(len(starts), -1, np.int64)
        if not len(self.hashes) or not len(starts):
            return found
        want = part_hashes(data, starts, ends)
        live = np.arange(len(starts))
        if rare:
            digit = self._digits(want, 8 * len(self._bits))
            live = np.flatnonzero(self._bits[digit >> 3] >> (digit & 7).astype(np.uint8) & 1)
        at = np.zeros(len(starts), np.int64)
        at[live] = np.searchsorted(self.hashes, want[live])
        while len(live):                               # more than once only for tokens of one hash
            live = live[at[live] < len(self.hashes)]
            live = live[self.hashes[at[live]] == want[live]]
            size, begin = (ends - starts)[live], self.ends[at[live]].astype(np.int64)
            same = self.ends[at[live] + 1] - begin == size
            checked = np.where(same, size, 0)
            unlike = np.concatenate([[0], np.cumsum(data[spread(starts[live], checked)] != self.data[spread(begin, checked)])])
            last = np.cumsum(checked)
            same &= unlike[last] == unlike[last - checked]
            found[live[same]] = at[live[same]]
            live = live[~same]
            at[live] += 1
        return found

    def ids_of(self, words: pa.Array, unk: int) -> np.ndarray:
        """Ids of a string array without nulls, ``unk`` for words that are no token."""
        out = np.full(len(words), unk, np.int32)
        for at in range(0, len(words), HASHED_WORDS):
            ends, data = _buffers(words[at: at + HASHED_WORDS])
            first = int(ends[0])
            starts, stops = ends[:-1].astype(np.int64) - first, ends[1:].astype(np.int64) - first
            found = self.find(data[first: int(ends[-1])], starts, stops)
            hit = np.flatnonzero(found >= 0)
            out[at + hit] = self.ids[found[hit]]
        return out


def words_at(text: str, codes: np.ndarray, at: np.ndarray) -> pa.Array:
    """``text``, whose code points are ``codes``, cut at the places ``at`` (the first is 0) into UTF-8 words."""
    data = text.encode()
    if len(data) != len(codes):
        at = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))])[at]
    ends = np.append(at, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)])


CHUNK_BYTES = 2 << 20        # of the texts that are encoded together
CACHE_PARTS = 300_000        # parts of texts an encoding task keeps,
CACHE_IDS = 4_000_000        # and their ids


class PartEncoder:
    """Texts -> id lists in a worker, an Arrow batch at a time.

    Texts are cut at their spaces and what lies between is encoded once (the parts of a task are kept, up to a bound); the ids
    of a text are those of its parts one after another, gathered without a loop over the words of the rows.  A subclass
    gives the ids of parts and names the texts that are not cut."""

    def __init__(self):
        self._reset()

    def _reset(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.lens, self.absent = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)

    def whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts are one part."""
        return np.zeros(len(texts), bool)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the number of ids of each, and whether a text with that part must be encoded whole."""
        raise NotImplementedError

    def _slots(self, parts: pa.Array) -> np.ndarray:
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = np.fromiter((self.slots.get(p, -1) for p in distinct), np.int64, len(distinct))
        new = [distinct[i] for i in np.flatnonzero(at < 0).tolist()]
        if new:
            flat, lens, absent = self.encode(new)
            at[at < 0] = np.arange(len(self.lens), len(self.lens) + len(new))
            self.slots.update(zip(new, range(len(self.lens), len(self.lens) + len(new))))
            self.flat, self.lens = np.concatenate([self.flat, flat.astype(np.int32)]), np.concatenate([self.lens, lens])
            self.absent = np.concatenate([self.absent, absent])
        return at[coded.indices.to_numpy(zero_copy_only=False)]

    def _chunk(self, texts: pa.Array, whole: np.ndarray) -> pa.Array:
        if len(self.slots) > CACHE_PARTS or len(self.flat) > CACHE_IDS:
            self._reset()
        cut = pc.split_pattern(texts.filter(pa.array(~whole)), " ")
        counts = np.concatenate([cut.value_lengths().to_numpy(zero_copy_only=False), np.ones(int(whole.sum()), np.int64)])
        slots = self._slots(pa.concat_arrays([cut.flatten(), texts.filter(pa.array(whole))]))
        order = np.concatenate([np.flatnonzero(~whole), np.flatnonzero(whole)])
        ends = np.concatenate([[0], np.cumsum(counts)])
        missing = self.absent[slots]
        if missing.any():
            again = np.zeros(len(texts), bool)
            again[order[np.diff(np.concatenate([[0], np.cumsum(missing)])[ends]) > 0]] = True
            again &= ~whole
            again[order[counts == 1]] = False
            if again.any():
                return self._chunk(texts, whole | again)
        lens = self.lens[slots]
        total = np.concatenate([[0], np.cumsum(lens)])[ends]
        ids = self.flat[spread((np.cumsum(self.lens) - self.lens)[slots], lens)]
        out = pa.ListArray.from_arrays(pa.array(total, pa.int32()), pa.array(ids))
        if not whole.any():
            return out
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return out.take(pa.array(back))

    def __call__(self, texts: pa.Array) -> pa.Array:
        """Id lists of texts without nulls."""
        texts = texts.cast(pa.string())
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))])
        out, at = [], 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK_BYTES, "right")) - 1)
            rows = texts.slice(at, end - at)
            out.append(self._chunk(rows, self.whole(rows)))
            at = end
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))


def _offsets(rows: pa.Array) -> pa.Array:
    """Offsets of the lists of ``rows`` within its flattened values; a null is an empty list."""
    return pa.array(np.concatenate([[0], np.cumsum(rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]), pa.int32())


def ids_udf(sent: Broadcast, unk: int = UNK_ID):
    """Token array -> id array (``unk`` when missing) over a shipped :class:`TokenIndex`; each distinct token of a batch once."""
    @F.arrow_udf("array<int>")
    def lookup(rows: pa.Array) -> pa.Array:
        index = sent.value
        words = rows.flatten().cast(pa.string()).dictionary_encode()
        ids = pa.array(index.ids_of(words.dictionary, unk), pa.int32())
        found = ids.take(words.indices).fill_null(unk if index.null_id is None else index.null_id)
        return pa.ListArray.from_arrays(_offsets(rows), found)
    return lookup


def decode_lists(sent: Broadcast, n_specials: int, sep: str):
    """Id lists -> their tokens joined by ``sep``, without specials and ids the vocabulary does not have."""
    def decode(rows: pa.Array) -> pa.Array:
        tokens, ids = sent.value
        known = ids.to_numpy()
        flat = rows.flatten().cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
        hit = (known[at] == flat) & (flat >= n_specials) if len(known) else np.zeros(len(flat), bool)
        ends = np.concatenate([[0], np.cumsum(hit)])[_offsets(rows).to_numpy()]
        words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens.take(pa.array(at[hit])))
        return pc.binary_join(words, sep)
    return decode


def _salted(exploded: DataFrame, on: str, vocab: DataFrame) -> DataFrame:
    """Left join on ``on``; a hot value is dealt to ``SALTS`` tasks by its place in the row."""
    left = exploded.withColumn("_salt", F.pmod("_pos", F.lit(SALTS)))
    right = vocab.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [on, "_salt"], "left").drop("_salt")


def word_ids(df: DataFrame, tokens: str, vocab: DataFrame, key: str = "pair_id",
             out: str = "ids", unk: int = UNK_ID, max_bytes: int = SHIP_BYTES) -> DataFrame:
    """``key, out`` with each token replaced by its vocabulary id (``unk`` when missing)."""
    sent = shipped_index(vocab, max_bytes)
    if sent is not None:
        return df.select(key, ids_udf(sent, unk)(F.col(tokens)).alias(out))
    exploded = df.select(key, F.posexplode_outer(tokens).alias("_pos", "_tok"))
    joined = _salted(exploded, "_tok", vocab.select(F.col("token").alias("_tok"), F.col("id").alias("_id")))
    return _regroup(joined, key, "_pos", F.coalesce(F.col("_id"), F.lit(unk)), out)


def decode_ids(df: DataFrame, ids: str, vocab: DataFrame, key: str = "pair_id",
               out: str = "text", n_specials: int = len(SPECIALS), sep: str = " ",
               max_bytes: int = SHIP_BYTES) -> DataFrame:
    """J4 + F18: ids -> tokens, specials skipped, joined by ``sep`` (the word form; the
    byte-level form decodes with :func:`tandem.functions.text.symbols_to_text`)."""
    sent = shipped(vocab, max_bytes)
    if sent is not None:
        return df.select(key, F.arrow_udf(decode_lists(sent, n_specials, sep), "string")(F.col(ids)).alias(out))
    kept = F.filter(F.col(ids), lambda x: x >= n_specials)
    exploded = df.select(key, F.posexplode_outer(kept).alias("_pos", "_id"))
    joined = _salted(exploded, "_id", vocab.select(F.col("id").alias("_id"), F.col("token").alias("_tok")))
    toks = _regroup(joined, key, "_pos", F.col("_tok"), "_toks")
    return toks.select(key, F.array_join("_toks", sep).alias(out))


def word_ids_sides(df: DataFrame, keys: list[str], sides: dict, vocab: DataFrame,
                   unk: int = UNK_ID, max_bytes: int = SHIP_BYTES) -> DataFrame:
    """J3 for several token columns at once: ``sides = {out_col: tokens Column}``; beyond ``max_bytes`` one explode, one
    join and one regroup by ``keys`` for all sides (no join back)."""
    sent = shipped_index(vocab, max_bytes)
    if sent is not None:
        lookup = ids_udf(sent, unk)
        return df.select(*keys, *(lookup(col).alias(name) for name, col in sides.items()))
    names = list(sides)

    def tag(j):
        return lambda t, i: F.struct(F.lit(j).alias("side"), i.alias("pos"), t.alias("_tok"))

    def of_side(j):
        return lambda x: x["side"] == j

    tagged = [F.transform(col, tag(j)) for j, col in enumerate(sides.values())]
    ex = df.select(*keys, F.explode_outer(F.concat(*tagged)).alias("x")).select(
        *keys, "x.side", F.col("x.pos").alias("_pos"), "x._tok")
    joined = _salted(ex, "_tok", vocab.select(F.col("token").alias("_tok"), F.col("id").alias("_id")))
    item = F.when(F.col("side").isNotNull(), F.struct(
        "side", F.col("_pos").alias("pos"), F.coalesce(F.col("_id"), F.lit(unk)).alias("id")))
    g = joined.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_s"))
    return g.select(*keys, *[F.transform(F.filter("_s", of_side(j)), lambda x: x["id"]).alias(name)
                             for j, name in enumerate(names)])
