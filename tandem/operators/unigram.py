"""Encoding with a given unigram vocabulary of pieces (F8, C3): normalisation, best-path segmentation of each
word (prefixed by U+2581), unknown characters as byte pieces or as the unknown id (runs merged), the end token
appended and the whole truncated to 128 ids including it (T14), plus the attention mask.  Ids follow the mT5
convention (T25): pad 0, end 1, unknown 2.

A row is encoded where it lies, by an Arrow UDF that encodes what lies between two spaces once: no explode, no shuffle, so no
hot word; the pieces go through the driver and to the workers as flat arrays, not as Python objects.  Ids are those of the public library's unigram model for the same pieces (tested).

The vocabulary is an input table ``pieces(piece, score, id)`` (the pre-trained one is not shipped);
:func:`pieces_from_counts` derives one from word counts for tests and examples.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import MAX_IDS, T5_EOS_ID, T5_UNK_ID
from ..functions.text import PY_WHITESPACE
from ..session import scratch_table
from .encode import PartEncoder, TokenIndex, collected, spread, words_at
from .split import dense_position

SPACE = "▁"
T5_SPECIALS = ["<pad>", "</s>", "<unk>"]
UNK_PENALTY = 10.0
LONG_WORD = 64               # characters from which a word's best path is found alone
MAX_PIECE_BYTES = 1 << 30    # pieces tables up to this size go to the workers
CANDIDATES = 1 << 20         # stretches looked up at a time
SCORE_DIGITS = 6             # of a derived piece, as in a written pieces file
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

# The public character rules that come before NFKC.  Controls that are dropped, and white space and
# invisible characters that become a space.
DROPPED = [*range(0x01, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F, 0x8F, 0x9F]
SPACED = [0x09, 0x0A, 0x0C, 0x0D, 0x1680, *range(0x200B, 0x2010), 0x2028, 0x2029, 0x2581, 0xFEFF, 0xFFFD]
CHARACTER_MAP = dict.fromkeys(DROPPED) | dict.fromkeys(SPACED, " ")


def normalise_pieces(text: str) -> str:
    """Character map, then NFKC; ASCII without controls is its own normal form."""
    if text.isascii() and text.isprintable():
        return text
    return unicodedata.normalize("NFKC", text.translate(CHARACTER_MAP))


def pieces_from_counts(counts: DataFrame, word: str = "word", count: str = "count",
                       min_count: int = 4) -> DataFrame:
    """A unigram vocabulary estimated from word counts: every word seen ``min_count`` times as a
    ``U+2581``-prefixed piece, every character (bare and prefixed) as a fallback piece; score =
    log relative frequency.  Ids after the three specials by (score desc, piece).  The counts are written once, as they are
    read for the sum and for the pieces."""
    counts = scratch_table(counts.select(word, count), "piece-counts")
    total = counts.agg(F.sum(count).alias("_t"))
    words = counts.where(F.col(count) >= min_count).select(
        F.concat(F.lit(SPACE), F.col(word)).alias("piece"), F.col(count).alias("c"))
    chars = counts.select(F.explode(F.regexp_extract_all(F.col(word), F.lit(r"(?s)."), 0)).alias("ch"),
                          F.col(count).alias("c"))
    char_pieces = chars.select(F.explode(F.array(F.col("ch"), F.concat(F.lit(SPACE), F.col("ch"))))
                               .alias("piece"), "c")
    allp = words.unionByName(char_pieces).groupBy("piece").agg(F.sum("c").alias("c"))
    n = total.first()["_t"] or 1
    scored = allp.select("piece", F.round(F.log(F.col("c")) - math.log(n), SCORE_DIGITS).alias("score"))
    ranked = dense_position(scored.withColumn("_neg", -F.col("score")), ["_neg", "piece"], out="_r")
    return ranked.select("piece", "score", (F.col("_r") + len(T5_SPECIALS)).cast("int").alias("id"))


@dataclass
class Pieces:
    """Pieces for the best path: ``longest`` bounds the pieces that start with a character; ``byte_ids`` is empty
    without byte fallback."""
    table: dict[str, tuple[float, int]]
    unk_score: float
    byte_ids: list[int] = field(default_factory=list)
    longest: dict[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: list[tuple[str, float, int]], byte_fallback: bool = False) -> "Pieces":
        lowest = min((s for _, s, _ in rows), default=0.0)
        found = {int(m[1], 16): i for p, _, i in rows if (m := BYTE_PIECE.fullmatch(p))} if byte_fallback else {}
        table = {p: (s, i) for p, s, i in rows if p and not (found and BYTE_PIECE.fullmatch(p))}
        out = cls(table, lowest - UNK_PENALTY, [found[b] for b in range(256)] if len(found) == 256 else [])
        for p in table:
            out.longest[p[0]] = max(out.longest.get(p[0], 0), len(p))
        return out

    def unknown(self, run: str) -> list[int]:
        return [self.byte_ids[b] for b in run.encode()] if self.byte_ids else [T5_UNK_ID]


def best_path(word: str, pieces: Pieces) -> list[int]:
    """Segmentation of highest total score, linear in the word: from every place the pieces that start there, and the
    character alone as unknown if it is no piece; among equal scores the one whose last piece is longest.  A run of unknown
    characters is one unknown, or its bytes."""
    n, table = len(word), pieces.table
    best = [0.0] + [-math.inf] * n
    back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
    for i, ch in enumerate(word):
        here = best[i]
        for j in range(i + 1, min(n, i + pieces.longest.get(ch, 0)) + 1):
            hit = table.get(word[i:j])
            if hit is not None and here + hit[0] > best[j]:
                best[j], back[j] = here + hit[0], (i, hit[1])
        if ch not in table and here + pieces.unk_score > best[i + 1]:
            best[i + 1], back[i + 1] = here + pieces.unk_score, (i, -1)
    path, i = [], n
    while i > 0:
        start, pid = back[i]
        if pid == -1 and path and path[-1][1] == -1:
            path[-1] = (start, -1, path[-1][2])
        else:
            path.append((start, pid, i))
        i = start
    out: list[int] = []
    for start, pid, end in reversed(path):
        out.extend(pieces.unknown(word[start:end]) if pid == -1 else (pid,))
    return out


def best_path_py(word: str, pieces: dict, max_len: int, unk_score: float) -> list[int]:
    """:func:`best_path` over a plain dictionary ``piece -> (score, id)``."""
    made = Pieces.of([(p, s, i) for p, (s, i) in pieces.items() if len(p) <= max_len])
    made.unk_score = unk_score
    return best_path(word, made)


@dataclass
class PieceIndex:
    """A pieces table as a worker holds it: flat arrays (:class:`TokenIndex`), from which the pieces that unseen words contain are looked up
    together; the best path of those words then runs over that small table."""
    index: TokenIndex
    unk_score: float
    byte_ids: list[int]
    longest: dict[str, int]

    @classmethod
    def of(cls, table: pa.Table, byte_fallback: bool = False) -> "PieceIndex":
        """``table`` holds ``token, id, score``; of equal pieces the first counts."""
        lowest = pc.min(table["score"]).as_py() if table.num_rows else 0.0
        found: dict[int, int] = {}
        if byte_fallback:
            raw = table.filter(pc.match_substring_regex(table["token"], f"^{BYTE_PIECE.pattern}$"))
            for piece, at in zip(reversed(raw["token"].to_pylist()), reversed(raw["id"].to_pylist())):
                found[int(BYTE_PIECE.fullmatch(piece)[1], 16)] = at
            if found:
                table = table.filter(pc.invert(pc.match_substring_regex(table["token"], f"^{BYTE_PIECE.pattern}$")))
        table = table.filter(pc.greater(pc.binary_length(table["token"]), 0))       # null pieces are dropped too
        first = pa.table({"first": pc.utf8_slice_codeunits(table["token"], 0, 1), "size": pc.utf8_length(table["token"])})
        longest = first.group_by("first").aggregate([("size", "max")])
        return cls(TokenIndex.of(table, "score"), lowest - UNK_PENALTY, [found[b] for b in range(256)] if len(found) == 256 else [],
                   dict(zip(longest["first"].to_pylist(), longest["size_max"].to_pylist())))

    def arcs(self, text: str, lens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first place, place behind, number) of the pieces in the words of ``text``, ``lens`` characters each: every stretch of a word up
        to the longest piece of its first character is looked up, by rising first place, a character alone once."""
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        data = np.frombuffer(text.encode(), np.uint8)
        place = np.concatenate([[0], np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000))]).astype(np.int64)
        kinds, kind = np.unique(chars, return_inverse=True)
        alone = _found(self.index, [chr(c) for c in kinds.tolist()])[kind]
        reach = np.array([self.longest.get(chr(c), 0) for c in kinds.tolist()], np.int64)[kind]
        reach = np.maximum(np.minimum(reach, np.repeat(np.cumsum(lens), lens) - np.arange(len(chars))) - 1, 0)     # of two characters or more
        total = np.cumsum(reach)
        at = 0
        while at < len(chars):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CANDIDATES, "right")))
            starts = np.repeat(np.arange(at, end), reach[at:end])
            stops = spread(np.arange(at, end) + 2, reach[at:end])
            low = int(place[at])
            found = self.index.find(data[low: int(place[stops.max()]) if len(stops) else low], place[starts] - low, place[stops] - low, rare=True)
            hit = np.flatnonzero(found >= 0)
            one = np.flatnonzero(alone[at:end] >= 0) + at
            yield np.concatenate([one, starts[hit]]), np.concatenate([one + 1, stops[hit]]), np.concatenate([alone[one], found[hit]])
            at = end

    def within(self, words: list[str]) -> Pieces:
        """The pieces that occur in ``words``."""
        text, out = "".join(words), Pieces({}, self.unk_score, self.byte_ids, self.longest)
        for starts, stops, found in self.arcs(text, np.array([len(w) for w in words], np.int64)):
            which, one = np.unique(found, return_index=True)
            for k, i in zip(which.tolist(), one.tolist()):
                out.table[text[starts[i]: stops[i]]] = float(self.index.scores[k]), int(self.index.ids[k])
        return out

    def best_paths(self, text: str, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:func:`best_path` of the words of ``text`` together: their ids one after another and the number of each word's.  A step takes
        the pieces that start at one place of every word."""
        n = len(text)
        word = np.repeat(np.arange(len(lens)), lens)
        begin = np.cumsum(lens) - lens
        found = [*self.arcs(text, lens)]
        start, stop, piece = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in range(3))
        known = np.zeros(n, bool)
        known[start[stop == start + 1]] = True
        lost = np.flatnonzero(~known)                    # an unknown character alone
        start, stop = np.concatenate([start, lost]), np.concatenate([stop, lost + 1])
        score = np.concatenate([self.index.scores[piece], np.full(len(lost), self.unk_score)])
        ids = np.concatenate([self.index.ids[piece].astype(np.int64), np.full(len(lost), -1)])
        step = start - begin[word[start]]
        order = np.argsort(step.astype(np.uint16 if len(lens) and lens.max() < 1 << 16 else np.int64), kind="stable")
        # a word of k characters has k + 1 nodes
        source, target, score, ids = (start + word[start])[order], (stop + word[start])[order], score[order], ids[order]
        best = np.full(n + len(lens), -math.inf)
        best[begin + np.arange(len(lens))] = 0.0
        back = np.zeros(n + len(lens), np.int64)
        cut = np.concatenate([[0], np.cumsum(np.bincount(step))]) if len(step) else np.zeros(1, np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            to, total = target[a:b], best[source[a:b]] + score[a:b]
            better = np.flatnonzero(total > best[to])
            best[to[better]] = total[better]
            back[to[better]] = better + a
        live = np.flatnonzero(lens > 0)
        node, first = (begin + lens + np.arange(len(lens)))[live], (begin + np.arange(len(lens)))[live]
        steps: list[tuple[np.ndarray, np.ndarray]] = []  # (words, ids) from the last piece to the first
        before = np.zeros(len(lens), bool)               # whether the piece behind is unknown too
        while len(live):
            arc = back[node]
            got = ids[arc]
            keep = ~((got < 0) & before[live])           # a run of unknown characters is one unknown
            before[live] = got < 0
            steps.append((live[keep], np.where(got < 0, T5_UNK_ID, got)[keep]))
            node = source[arc]
            more = node != first
            live, node, first = live[more], node[more], first[more]
        if not steps:
            return np.zeros(0, np.int64), np.zeros(len(lens), np.int64)
        words = np.concatenate([w for w, _ in reversed(steps)])
        return np.concatenate([x for _, x in reversed(steps)])[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(lens))


def _found(index: TokenIndex, words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    return index.find(np.frombuffer(b"".join(data), np.uint8), ends[:-1], ends[1:])


_MAPPED = re.compile("[" + "".join(re.escape(chr(c)) for c in CHARACTER_MAP if c != 0x0A) + "]")
_WHITE = np.zeros(ord(max(PY_WHITESPACE)) + 2, bool)
_WHITE[[*map(ord, PY_WHITESPACE)]] = True


class PieceEncoder(PartEncoder):
    """F8 of texts in a worker.  Normalisation composes nothing with a space, so a text is encoded part by part between its spaces."""

    def __init__(self, index: PieceIndex):
        super().__init__()
        self.index = index

    def parts(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The words of the normalised parts and their number in each part; a line feed stands between two parts meanwhile."""
        plain = " ".join(texts)
        if not (plain.isascii() and plain.isprintable()):
            plain = _MAPPED.sub(lambda m: CHARACTER_MAP[ord(m[0])] or "", plain.replace("\n", "\t").replace(" ", "\n"))
            plain = unicodedata.normalize("NFKC", plain)
            codes = np.frombuffer(plain.encode("utf-32-le"), np.uint32)
            part = np.cumsum(codes == 0x0A)
        else:
            codes = np.frombuffer(plain.encode("utf-32-le"), np.uint32)
            part = np.cumsum(codes == 0x20)
        white = _WHITE[np.minimum(codes, len(_WHITE) - 1)]
        at = np.flatnonzero(np.concatenate([[len(codes) > 0], white[1:] != white[:-1]])) if len(codes) else np.zeros(0, np.int64)
        words = words_at(plain, codes, at)
        real = ~white[at]
        return words.filter(pa.array(real)), np.bincount(part[at[real]], minlength=len(texts))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, counts = self.parts(texts)
        coded = words.dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        flat, lens = self._paths([SPACE + w.decode() for w in coded.dictionary.to_pylist()])
        sizes = lens[at]
        total = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return flat[spread((np.cumsum(lens) - lens)[at], sizes)], np.diff(total), np.zeros(len(texts), bool)

    def _paths(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        if self.index.byte_ids:                          # an unknown character is several ids
            known = self.index.within(words)
            found = [best_path(w, known) for w in words]
        else:
            long = np.flatnonzero(size > LONG_WORD).tolist()
            alone = [words[i] for i in long]
            known = self.index.within(alone)
            if not long:
                return self.index.best_paths("".join(words), size)
            flat, lens = self.index.best_paths("".join(w for w in words if len(w) <= LONG_WORD), size[size <= LONG_WORD])
            ends = np.cumsum(lens)
            found = [flat[e - n: e].tolist() for e, n in zip(ends.tolist(), lens.tolist())]
            for i, w in zip(long, alone):
                found.insert(i, best_path(w, known))
        lens = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.int64, int(lens.sum())), lens


_KEPT: dict[str, PieceEncoder] = {}


def _encoder(name: str, index: PieceIndex) -> PieceEncoder:
    """The encoder of a pieces table, once a worker process for all text columns (the one in use is kept)."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = PieceEncoder(index)
    return _KEPT[name]


def unigram_encoder(spark, pieces: DataFrame, byte_fallback: bool = False):
    """Arrow UDF text -> ids over a shipped :class:`PieceIndex` (size checked first)."""
    table = collected(pieces, MAX_PIECE_BYTES, "piece", ["score"], descending=True)
    if table is None:
        raise ValueError(f"pieces table has more than {MAX_PIECE_BYTES} bytes; too large to send to the workers")
    table = table.set_column(table.column_names.index("score"), "score", table["score"].cast(pa.float64()))
    bc = spark.sparkContext.broadcast(PieceIndex.of(table, byte_fallback))
    name = uuid.uuid4().hex

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def enc(texts: pa.Array) -> pa.Array:
        return _encoder(name, bc.value)(texts.fill_null(""))
    return enc


def capped_ids(ids: str, max_ids: int = MAX_IDS):
    """The first ``max_ids - 1`` ids and the end token."""
    return F.concat(F.slice(ids, 1, max_ids - 1), F.array(F.lit(T5_EOS_ID)))


def unigram_encode(df: DataFrame, text: str, pieces: DataFrame, key: str | Sequence[str] = "pair_id",
                   max_ids: int = MAX_IDS, byte_fallback: bool = False, encoder=None) -> DataFrame:
    """F8: ``key, input_ids, attention_mask``; the end token is inside the ``max_ids`` cap.  With ``byte_fallback`` (and
    all 256 pieces ``<0x00>`` to ``<0xFF>`` in the table) unknown characters become their UTF-8 bytes.  ``encoder`` is a
    :func:`unigram_encoder` of the pieces made before."""
    keys = [key] if isinstance(key, str) else list(key)
    enc = encoder or unigram_encoder(df.sparkSession, pieces, byte_fallback)
    ids = df.select(*keys, enc(F.col(text)).alias("_ids"))
    return ids.select(*keys, capped_ids("_ids", max_ids).alias("input_ids")).withColumn(
        "attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))


def unigram_encode_sides(df: DataFrame, sides: dict[str, str], pieces: DataFrame, key: Sequence[str],
                         max_ids: int = MAX_IDS, byte_fallback: bool = False) -> DataFrame:
    """F8 of several text columns in one pass and one worker: ``sides`` = {text: name} gives ``key, <name>_ids, <name>_mask`` each."""
    enc = unigram_encoder(df.sparkSession, pieces, byte_fallback)
    ids = df.select(*key, *(enc(F.col(text)).alias(f"_{name}") for text, name in sides.items()))
    capped = ids.select(*key, *(capped_ids(f"_{name}", max_ids).alias(f"{name}_ids") for name in sides.values()))
    return capped.select(*key, *(c for name in sides.values() for c in (
        F.col(f"{name}_ids"), F.array_repeat(F.lit(1), F.size(f"{name}_ids")).alias(f"{name}_mask"))))
