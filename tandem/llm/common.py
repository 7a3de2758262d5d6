"""Shared helpers: bounded Arrow slices, vectorised word splitting, tables in the shared folder.

All text work inside tasks is done on Arrow buffers in slices of a few MB, so the memory of a
Python worker does not grow with the partition.  Words are byte runs: both word classes used here
(``SPACE_WORDS``, ``ALNUM_WORDS``) are unions of byte ranges of UTF-8, every byte >= 0x80 being a
word byte, so splitting on bytes equals splitting on characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tandem.session import scratch_path

SLICE_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
SPACE_WORDS = np.ones(256, bool)          # [^\x20\x09-\x0D]+
SPACE_WORDS[_SPACES] = False
ALNUM_WORDS = np.zeros(256, bool)         # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing
ALNUM_WORDS[0x30:0x3A] = True
ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls; offsets start at 0."""
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off_buf, data = texts.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64 if wide else np.int32)
    off = off[texts.offset: texts.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, dtype=np.uint8)[off[0]: off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``limit`` bytes of text (or one row); nulls of
    the text column become empty texts."""
    for batch in batches:
        i = batch.schema.get_field_index(text)
        filled = batch.column(i).fill_null("")
        batch = batch.set_column(i, text, filled)
        _, off = text_bytes(filled)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
            to = max(at + 1, min(to, batch.num_rows))
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Words of the documents of one slice: ``codes`` index ``uniq``; document d owns
    ``codes[doc[d]:doc[d+1]]``."""

    codes: np.ndarray
    uniq: pa.Array
    doc: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def uniq_bytes(self) -> list[bytes]:
        return self.uniq.to_pylist()

    def hashes(self) -> np.ndarray:
        """64-bit hash of each distinct word."""
        f = xxhash.xxh3_64_intdigest
        return np.fromiter((f(b) for b in self.uniq.to_pylist()), np.uint64, len(self.uniq))


def split_words(texts: pa.Array, is_word: np.ndarray, lower: bool = True) -> Words:
    data, off = text_bytes(texts)
    low = LOWER[data] if lower else data
    isw = is_word[low]
    first = isw.copy()
    first[1:] &= ~isw[:-1]
    at = off[:-1][off[:-1] < len(low)]
    first[at] = isw[at]                      # a word never crosses a document
    starts = np.flatnonzero(first)
    doc = np.searchsorted(starts, off)
    packed = np.ascontiguousarray(low[isw])
    offsets = np.append(np.flatnonzero(first[isw]), len(packed)).astype(np.int32)
    arr = pa.Array.from_buffers(pa.binary(), len(starts),
                                [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    enc = arr.dictionary_encode()
    codes = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(codes, enc.dictionary, doc.astype(np.int64))


def segment_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i+1]]`` per segment (empty segments: 0)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[bounds[1:]] - total[bounds[:-1]]


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(starts[i], starts[i] + lens[i])``."""
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    head = np.cumsum(lens) - lens
    return np.arange(total, dtype=np.int64) + np.repeat(starts - head, lens)


def mix64(x: np.ndarray, seed: int) -> np.ndarray:
    """Bijection of 64-bit integers (xor-shift and odd multiplications)."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(word_hash: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the n-word shingles of each document in order; a document of fewer words,
    but not none, has its whole sequence as one shingle."""
    lens = np.diff(doc)
    full = np.maximum(lens - n + 1, 0)
    counts = np.where(lens >= n, full, (lens > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    out = np.empty(int(bounds[-1]), np.uint64)
    long = np.flatnonzero(lens >= n)
    at = ranges(doc[long], full[long])
    h = np.full(len(at), np.uint64(n * 0x9E3779B9), np.uint64)
    for k in range(n):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + word_hash[at + k], 0xA5A5A5A5 + k)
    out[ranges(bounds[long], full[long])] = h
    for d in np.flatnonzero((lens > 0) & (lens < n)):
        raw = word_hash[doc[d]: doc[d + 1]].tobytes()
        out[bounds[d]] = np.uint64(xxhash.xxh3_64_intdigest(raw, seed=int(lens[d])))
    return out, bounds


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a fresh folder below spark.checkpoint.dir and read it back: lineage is
    cut and lost executors cost nothing that was done before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
