"""Embedding whitening (12): Golub-Kahan-Lanczos bidiagonalisation of the centred distinct vectors.

With A the centred rows, the recurrences build A V = U B with orthonormal U, V and an upper bidiagonal B: one
step needs A v and then the transposed product with the new left vector.  Left vectors have one entry a row, so they are never stored: u is kept
as the short vector w with u = A w, a pass over the rows computes A w and at once A^T (A w) inside the tasks, and only sums of d numbers
come back.  Both sides are fully reorthogonalised (u_j . A w = w_j . A^T A w).  Rows are quantised integers,
so centring is exact up to one rounding.

The bidiagonalisation goes on until the wanted residuals are at rounding level and what is left of the
trace is too small to hide another component as large; where it is not, to the last of the d steps, with a new
start vector wherever it breaks down, so repeated deviations are found too.  The SVD of the small B gives components
and deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import written
from tandem.llm.vectors import LONG_MAX, largest, matrix, pack, quantised, unpack, width

BLOCK = 4096                # rows of a packed block
TINY = 1e-12                # relative to the largest entry of B: taken as zero
CONVERGED = 1e-13           # residual of a component, relative to the largest deviation
START = 20_240_607


def numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: int64, or Python integers where they could not hold it."""
    if largest(x) * n + max(map(abs, sums), default=0) <= LONG_MAX:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return numerators(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of squared numerators of each row; None beyond the range of long."""
    z = numerators(x, n, sums)
    if z.dtype != object and largest(z) ** 2 * max(1, z.shape[1]) <= LONG_MAX:
        return (z * z).sum(axis=1).tolist()
    z = z.astype(object)
    return [v if v <= LONG_MAX else None for v in (z * z).sum(axis=1).tolist()]


def fit_blocks(rows: DataFrame, d: int) -> DataFrame:
    """The fit list, each distinct x once, packed: (n, block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                m = matrix(b.column("x").slice(at, BLOCK), d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(m)], pa.int64()), pa.array([pack(m)], pa.binary())], names=["n", "block"])

    pad = F.concat("x", F.array_repeat(F.lit(0).cast("long"), d - F.size("x")))
    return rows.select(pad.alias("x")).distinct().mapInArrow(run, "n long, block binary")


def summed(blocks: DataFrame, cells: Callable[[np.ndarray], np.ndarray], d: int) -> np.ndarray:
    """Sum over all blocks of ``cells(block rows)``, an array of a fixed, small shape: every task adds its own blocks, Spark adds the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for raw in b.column("block").to_pylist():
                part = cells(unpack(raw, d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "v"])

    got = blocks.select("block").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(got))
    for r in got:
        out[r["at"]] = r["v"]
    return out


def exact_sums(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the exact sum of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("block").to_pylist():
                m = unpack(raw, d)
                high, low = m >> 32, m & 0xFFFFFFFF         # sums of BLOCK halves stay within long
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(d)), pa.array(high.sum(axis=0)), pa.array(low.sum(axis=0))], names=["at", "hi", "lo"])

    wide = "decimal(38,0)"
    got = (blocks.select("block").mapInArrow(run, "at long, hi long, lo long").groupBy("at")
           .agg(F.sum(F.col("hi").cast(wide)).alias("hi"), F.sum(F.col("lo").cast(wide)).alias("lo")).collect())
    sums = [0] * d
    for r in got:
        sums[r["at"]] = (int(r["hi"]) << 32) + int(r["lo"])
    return blocks.agg(F.sum("n")).first()[0] or 0, sums


def _against(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """v without its parts along the orthonormal basis (twice, for rounding)."""
    if basis:
        q = np.array(basis)
        for _ in range(2):
            v = v - q.T @ (q @ v)
    return v


def bidiagonalise(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int,
                  energy: float) -> tuple[np.ndarray, np.ndarray]:
    """(deviations, components) of A, the ``wanted`` largest at most; product(w) = A^T (A w), energy = sum of A's squared entries."""
    rnd = np.random.default_rng(START)
    right: list[np.ndarray] = []
    left: list[np.ndarray] = []            # w with u = A w
    image: list[np.ndarray] = []           # A^T u
    alpha: list[float] = []
    beta: list[float] = []                 # beta[k] joins step k to step k + 1

    def fresh() -> np.ndarray:
        v = _against(rnd.standard_normal(d), right)
        return v / np.linalg.norm(v)

    v = fresh()
    while True:
        right.append(v)
        w = v - beta[-1] * left[-1] if beta else v
        g = product(w)
        for _ in range(2 if left else 0):
            c = np.array(left) @ g
            w, g = w - c @ np.array(left), g - c @ np.array(image)
        a = float(np.sqrt(max(0.0, w @ g)))
        if a <= TINY * max([a, *alpha, *beta]) or not a:
            a, w, g = 0.0, np.zeros(d), np.zeros(d)
        else:
            w, g = w / a, g / a
        left.append(w), image.append(g), alpha.append(a)
        small = np.diag(alpha) + np.diag(beta, 1)
        p, s, q = np.linalg.svd(small)
        if len(right) == d:
            break
        r = _against(g - a * v, right)
        b = float(np.linalg.norm(r))
        hidden = energy - float(np.sum(small * small))
        if len(s) >= wanted and b * np.abs(p[-1, :wanted]).max() <= CONVERGED * s[0] and hidden < s[wanted - 1] ** 2:
            break
        if b <= TINY * max([*alpha, *beta]) or not b:
            b, v = 0.0, fresh()
        else:
            v = r / b
        beta.append(b)
    s = s[:wanted]
    keep = s > 100 * TINY * s[0] if s[0] > 0 else s > 0
    vectors = q[:wanted] @ np.array(right)
    return s[keep], vectors[keep]


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
           components: int = 4) -> DataFrame:
    """vec_id (named as ``key``), component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector
    that takes part and each of the first ``components`` principal components of the distinct quantised vectors.

    n is the number of distinct vectors, deviation the exact sum of (n*x - S)^2 (null beyond long), whitened the
    projection of x - S/n over the component's deviation, explained the component's share of the trace,
    identity_error the largest absolute entry of whitened's covariance over the distinct vectors minus the identity.

    Null vectors and those with null or non-finite entries are left out; shorter ones count as padded with 0; repeated rows each
    get their rows, their vector counts once.  Components of deviation zero are not returned, so a table whose vectors are all equal,
    or an empty one, gives no row.  Tied deviations: any basis of their space.  Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = written(quantised(vectors, key, vector, scale), "vectors")
    kind = rows.schema["key"].dataType.simpleString()
    schema = (f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    d = width(rows)
    blocks = written(fit_blocks(rows, d), "fit").persist(StorageLevel.MEMORY_AND_DISK) if d else None
    n, sums = exact_sums(blocks, d) if d else (0, [])
    if n < 2:
        return spark.createDataFrame([], schema)

    def product(w: np.ndarray) -> np.ndarray:
        def cells(x: np.ndarray) -> np.ndarray:
            a = centred(x, n, sums)
            return a.T @ (a @ w)
        return summed(blocks, cells, d)

    energy = float(summed(blocks, lambda x: np.square(centred(x, n, sums)).sum(keepdims=True), d)[0])
    deviation, found = bidiagonalise(product, d, min(components, d), energy)
    basis = found.T * (np.sqrt(n) / deviation)          # projection over sqrt(e), e = deviation^2 / n
    k = len(deviation)

    def second(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, sums) @ basis
        return y.T @ y / n

    error = float(np.abs(summed(blocks, second, d).reshape(k, k) - np.eye(k)).max())
    blocks.unpersist()
    share = deviation ** 2 / energy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                x = matrix(part.column("x"), d)
                size = len(x)
                who = pa.array(np.repeat(np.arange(size), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(who), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                     pa.array(np.full(size * k, n)), pa.array(deviations(x, n, sums), pa.int64()).take(who),
                     pa.array((centred(x, n, sums) @ basis).ravel()), pa.array(np.tile(share, size)),
                     pa.array(np.full(size * k, error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
