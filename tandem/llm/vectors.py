"""Shared by the vector operators: quantised rows, padded integer matrices, packed blocks.

A vector takes part if it is not null and holds neither nulls nor non-finite entries.  Entries become
``floor(scale * entry)`` as long (beyond the range of long: its limits).  Vectors may differ in length: a
missing entry counts as 0, an empty vector is all zeros.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import ranges

LONG_MAX = (1 << 63) - 1
KINDS = (np.int16, np.int32, np.int64)


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def quantised(vectors: DataFrame, key: str, vector: str, scale: int, **more: Column) -> DataFrame:
    """(key, x array<long>, more) of the vectors that take part; ``more`` are columns over ``vectors``."""
    v = F.col("v")
    return (vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"),
                           *(c.alias(n) for n, c in more.items()))
            .where(v.isNotNull() & F.forall(v, _finite))
            .select("key", F.transform(v, lambda c: F.floor(c * float(scale))).alias("x"), *more))


def width(rows: DataFrame, x: str = "x") -> int:
    """Entries of the longest vector."""
    return rows.agg(F.max(F.size(x))).first()[0] or 0


def matrix(column: pa.ListArray, d: int) -> np.ndarray:
    """Rows of a list<long> column as an int64 matrix of d columns, padded with 0."""
    n = len(column)
    lens = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if n and (lens == d).all():
        return flat.reshape(n, d)
    out = np.zeros((n, d), np.int64)
    out[np.repeat(np.arange(n), lens), ranges(np.zeros(n, np.int64), lens)] = flat
    return out


def largest(m: np.ndarray) -> int:
    """Largest absolute entry, as a Python int."""
    return max(int(m.max()), -int(m.min())) if m.size else 0


def pack(m: np.ndarray) -> bytes:
    """One byte for the width of an entry, then the rows in the narrowest of 2, 4 and 8 bytes."""
    lo, hi = (int(m.min()), int(m.max())) if m.size else (0, 0)
    kind = next(k for k in KINDS if np.iinfo(k).min <= lo and hi <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + np.ascontiguousarray(m, kind).tobytes()


def unpack(raw: bytes, d: int) -> np.ndarray:
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[raw[0]]
    flat = np.frombuffer(raw, kind, offset=1).astype(np.int64)
    return flat.reshape(-1, d)
