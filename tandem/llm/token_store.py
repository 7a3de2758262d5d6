"""Token-ID / binary output (7): directly addressable codes.

Ids are split into ``WIDTH``-bit chunks.  Level 0 holds the lowest chunk of every id and a bitmap
that tells which ids continue; level 1 holds the next chunk of those only, and so on.  Every bitmap
has a rank directory (ones before each ``BLOCK`` bits), so the chunk of id i on the next level is
found by one directory entry and a popcount: any token is read without decoding a block.

Files are Parquet tables, one row a segment (a run of whole documents in ascending key order):
part, seq, doc keys and lengths, n_tokens and the coded payload.  Spark's writer commits them, so
lost executors and repeated tasks leave no half-written segment.

Payload, little-endian: b"DAC1", n (u64), levels (u32), then per level: count (u64), chunk bytes,
bitmap bytes, rank directory (u32 per BLOCK ids).  The last level has no bitmap or directory.

Tokenizing: a byte-level tokenizer's pre-tokens never cross the points where a word, together with
the one blank before it, begins, and a white-space run is one pre-token up to its last character.
Texts are therefore cut there (and between ASCII letters and ASCII punctuation other than the
apostrophe), equal pieces are found by an exact Arrow dictionary, and each is split into pre-tokens
and encoded by the tokenizer's own model once per slice (and kept in a bounded cache); texts with white
space beyond ASCII, and texts that hold the string of an added token, are encoded whole.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.llm.common import partitions, ranges, slices, text_bytes
from tandem.llm.token_counts import byte_alphabet

WIDTH, BLOCK = 8, 512
SEGMENT_TOKENS = 1 << 19
CACHE_WORDS = 1_500_000
MAGIC = b"DAC1"
#: White space and separators beyond the six ASCII ones: such texts are encoded whole.
ODD_SPACE = "[\x1c-\x1f\u0085  ᠎ -     　]"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: 1: ASCII letters, 2: ASCII punctuation but the apostrophe, 0 or over 4: neither
_KIND = np.full(256, 8, np.uint8)
for _b in range(33, 127):
    _KIND[_b] = 1 if chr(_b).isalpha() else 8 if chr(_b).isdigit() or _b == 0x27 else 2


def dac_encode(ids: np.ndarray) -> bytes:
    left = np.asarray(ids, np.uint32)
    levels = []
    while True:
        chunk = (left & np.uint32((1 << WIDTH) - 1)).astype(np.uint8)
        more = (left >> np.uint32(WIDTH)) > 0
        if not more.any():
            levels.append(struct.pack("<Q", len(left)) + chunk.tobytes())
            break
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(more), BLOCK))
        rank = (np.cumsum(ones) - ones).astype("<u4")
        levels.append(struct.pack("<Q", len(left)) + chunk.tobytes() + bits.tobytes() + rank.tobytes())
        left = left[more] >> np.uint32(WIDTH)
    return MAGIC + struct.pack("<QI", len(ids), len(levels)) + b"".join(levels)


class DacReader:
    """Random access into one payload: ``len(r)``, ``r[i]``, ``r.all()``."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC1 payload")
        self.n, count = struct.unpack_from("<QI", payload, 4)
        at, self.levels = 16, []
        for k in range(count):
            (n,) = struct.unpack_from("<Q", payload, at)
            chunk = np.frombuffer(payload, np.uint8, n, at + 8)
            at += 8 + n
            bits = rank = None
            if k + 1 < count:
                bits = np.frombuffer(payload, np.uint8, (n + 7) // 8, at)
                at += len(bits)
                rank = np.frombuffer(payload, "<u4", (n + BLOCK - 1) // BLOCK, at)
                at += 4 * len(rank)
            self.levels.append((chunk, bits, rank))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for chunk, bits, rank in self.levels:
            value |= int(chunk[i]) << shift
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            begin = i // BLOCK * BLOCK
            whole = int(_ONES[bits[begin >> 3: i >> 3]].sum())
            part = bin(int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).count("1")
            i, shift = int(rank[i // BLOCK]) + whole + part, shift + WIDTH
        return value

    def all(self) -> np.ndarray:
        out = self.levels[0][0].astype(np.uint32)
        where = np.arange(self.n)
        for k in range(1, len(self.levels)):
            _, bits, _ = self.levels[k - 1]
            where = where[np.unpackbits(bits, count=len(where), bitorder="little").astype(bool)]
            out[where] |= self.levels[k][0].astype(np.uint32) << np.uint32(WIDTH * k)
        return out


#: Fixed value: the pre-token pattern of byte-level BPE files.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class PieceEncoder:
    """Ids of pieces by the tokenizer's own model.  The first ``CACHE_WORDS`` pieces stay cached in
    Arrow and numpy arrays (frequent ones come early)."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        #: texts that no piece may be cut from: added tokens are found in the whole text only
        self.uncut = "|".join([ODD_SPACE, *map(re.escape, added)])
        self.tokenize = self.tokenizer.model.tokenize
        self.find = regex.compile(PRE_TOKEN).findall
        self.table = {b: c for c, b in byte_alphabet().items()}
        self.known = pa.array([], pa.binary())
        self.flat, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, ends, table, tokenize = [], [], self.table, self.tokenize
        for p in pieces:
            if p.isalpha() or p[1:].isalpha() and p[0] == 0x20:
                flat += [t.id for t in tokenize(p.decode("latin-1").translate(table))]
            else:
                for w in self.find(p.decode("utf-8")):
                    flat += [t.id for t in tokenize(w.encode().decode("latin-1").translate(table))]
            ends.append(len(flat))
        return np.array(flat, np.uint32), np.diff(np.array([0, *ends], np.int64))

    def pieces(self, uniq: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all known and new pieces joined, start and number of ids per piece of ``uniq``)."""
        at = pc.index_in(uniq, value_set=self.known).to_numpy(zero_copy_only=False)
        miss = np.flatnonzero(np.isnan(at)) if at.dtype.kind == "f" else np.zeros(0, np.int64)
        place = np.nan_to_num(at).astype(np.int64)
        flat, size = self.flat, self.size
        if len(miss):
            new = uniq.take(pa.array(miss))
            more, n = self._encode(new.to_pylist())
            place[miss] = len(size) + np.arange(len(miss))
            flat, size = np.concatenate([flat, more]), np.concatenate([size, n])
            room = CACHE_WORDS - len(self.known)
            if room > 0:
                self.known = pa.concat_arrays([self.known, new.slice(0, room)])
                self.size = size[: len(self.known)]
                self.flat = flat[: int(self.size.sum())]
        starts = np.cumsum(size) - size
        return flat, starts[place], size[place]

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Cut texts at points no pre-token crosses: (pieces that tile the texts, pieces per text as bounds)."""
    data, off = text_bytes(texts)
    blank = _BLANK[data]
    cut = np.zeros(len(data) + 1, bool)
    begin = off[:-1][np.diff(off) > 0]
    inside = np.ones(len(data), bool)
    inside[begin] = False                                    # has a character before it
    prev_blank = np.concatenate([[False], blank[:-1]]) & inside
    cut[:-1] |= blank & ~prev_blank & inside                 # a white-space run begins
    word = np.flatnonzero(~blank & prev_blank)               # a word after white space
    cut[word - 1] = True
    cut[word[data[word - 1] != 0x20]] = True
    kind = _KIND[data]
    cut[1:-1] |= (kind[1:] + kind[:-1]) == 3                 # ASCII letter next to punctuation
    cut[begin] = True
    at = np.flatnonzero(cut[:-1])
    offsets = np.append(at, len(data)).astype(np.int32)
    arr = pa.Array.from_buffers(pa.binary(), len(at),
                                [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return arr, np.searchsorted(at, off).astype(np.int64)


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts joined, bounds per text)."""
    enc_of = encoder(path)
    odd = pc.match_substring_regex(texts, enc_of.uncut).to_numpy(zero_copy_only=False).astype(bool)
    plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
    arr, bounds = _pieces(plain)
    enc = arr.dictionary_encode()
    codes = enc.indices.to_numpy(zero_copy_only=False)
    flat, starts, size = enc_of.pieces(enc.dictionary)
    lens = size[codes]
    ids = flat[ranges(starts[codes], lens)]
    total = np.concatenate([[0], np.cumsum(lens)])[bounds]
    if not odd.any():
        return ids, total
    parts = []
    for i, is_odd in enumerate(odd):
        if is_odd:
            parts.append(np.array(enc_of.whole(texts[i].as_py()), np.uint32))
        else:
            parts.append(ids[total[i]: total[i + 1]])
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, key: str = "doc_id",
                 text: str = "text") -> None:
    """Encode every text (null: empty), append ``end_id`` to each and write segments to ``path`` in
    ascending key order (null keys first, equal keys by text).

    Rows are range-partitioned by key, so part p holds smaller keys than part p+1; repeated rows
    are encoded as often as they occur.  An empty table writes no segment.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        keys, lens, ids, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            all_keys = pa.concat_arrays(keys)
            n = np.concatenate(lens)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, len(all_keys)], pa.int32()), all_keys),
                 pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.array(n, pa.int64())),
                 pa.array([int(n.sum())], pa.int64()),
                 pa.array([dac_encode(np.concatenate(ids))], pa.binary())],
                names=["part", "seq", "keys", "lens", "n_tokens", "payload"])

        for b in slices(batches, text, 6 << 20):
            got, bounds = encode_texts(b.column(text), tokenizer_path)
            n = np.diff(bounds)
            out = np.full(len(got) + len(n), end_id, np.uint32)
            out[ranges(bounds[:-1] + np.arange(len(n)), n)] = got
            keys.append(b.column(key))
            lens.append(n + 1)
            ids.append(out)
            held += len(out)
            if held >= SEGMENT_TOKENS:
                yield flush()
                seq, held = seq + 1, 0
                keys, lens, ids = [], [], []
        if keys:
            yield flush()

    schema = f"part int, seq int, keys array<{kind}>, lens array<bigint>, n_tokens bigint, payload binary"
    (docs.select(key, text).repartitionByRange(partitions(spark), F.col(key).asc_nulls_first())
     .sortWithinPartitions(F.col(key).asc_nulls_first(), text)
     .mapInArrow(run, schema).write.option("compression", "zstd").parquet(path))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start`` = ids of all segments before.  Two-level prefix sums: within a part
    over its segments, then over the parts (one row per writing task)."""
    seg = spark.read.parquet(path)
    heads = seg.select("part", "seq", "n_tokens")
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)))
    parts = heads.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    heads = heads.join(parts, "part").select(
        "part", "seq", (F.col("base") + F.col("in_part")).alias("start"))
    return seg.join(heads, ["part", "seq"])


def read_documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start, n_tokens, ids_crc32 (unsigned, of the ids as
    little-endian 32-bit integers)."""
    seg = read_segments(spark, path).select("keys", "lens", "start", "payload")
    kind = seg.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids = DacReader(b.column("payload")[i].as_py()).all().astype("<u4")
                lens = b.column("lens")[i].values.to_numpy(zero_copy_only=False)
                bounds = np.concatenate([[0], np.cumsum(lens)])
                crc = [zlib.crc32(ids[s:e]) for s, e in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column("keys")[i].values,
                     pa.array(bounds[:-1] + b.column("start")[i].as_py(), pa.int64()),
                     pa.array(lens, pa.int64()), pa.array(crc, pa.int64())],
                    names=[key, "start", "n_tokens", "ids_crc32"])

    return seg.mapInArrow(run, f"{key} {kind}, start long, n_tokens long, ids_crc32 long")
