"""Exact top-k inner products (13): block-at-a-time pruning.

Rows are put in an order that keeps alike vectors together (nearest of ``PIVOTS`` pivots, fitted on a bounded
sample; it moves work, never results) and cut into document ranges of ``BLOCK`` rows.  A range is one row of the
index: its forward index (all its vectors, packed) and the maximum of every term.  A component is two terms, its
positive and its negative part, so a block keeps the largest and the smallest entry of each component.

A query's bound for a block is the sum of its term maxima times the query's weights.  Each task takes its
blocks in spans; in a span every query visits the blocks by falling bound, scores them through their
forward index, and stops when the bound falls below its k-th best score so far (a block whose bound
equals it may still hold a tie of smaller id and is scored).  The k-th best starts from the query's own block, which
is scored while the queries are listed.  Queries go to the tasks in groups of at most ``GROUP_BYTES``, one job a
group, so what is broadcast does not grow with the data.  Tasks emit at most k rows a query; one window keeps k.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.common import partitions, written
from tandem.llm.vectors import LONG_MAX, largest, matrix, pack, quantised, unpack, width
from tandem.session import scratch_path

BLOCK = 128                 # rows of a document range
SPAN = 64                   # blocks a task orders at a time
PIVOTS = 64
GROUP_BYTES = 16 << 20      # vectors of a group of queries
LAST = LONG_MAX             # order of a null id: behind all others

INDEX = "block long, ids binary, asks binary, rows binary, high binary, low binary"
NAMES = [f.split()[0] for f in INDEX.split(", ")]
ASKED = "block long, place int, id long, x binary, floor long"


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integer matrices, exact; beyond the range of long: its limits."""
    most = largest(a) * largest(b) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most <= LONG_MAX:
        return a @ b.T
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, -LONG_MAX - 1, LONG_MAX).astype(np.int64)


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Summed term maxima: no row of the block scores higher."""
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    return products(np.hstack([plus, minus]), np.hstack([high, low]))


def pivots(rows: DataFrame, d: int) -> np.ndarray:
    """Unit vectors of ``PIVOTS`` distinct rows, those of least hash."""
    found = (rows.groupBy(F.xxhash64("x").alias("h")).agg(F.first("x").alias("x"))
             .orderBy("h").limit(PIVOTS).select("x").collect())
    if not found or not d:
        return np.zeros((0, d))
    m = np.array([list(r.x) + [0] * (d - len(r.x)) for r in found], np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1.0)


def _placed(rows: DataFrame, d: int, found: np.ndarray) -> DataFrame:
    """Adds the nearest pivot and the nearness to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = matrix(b.column("x"), d).astype(np.float64)
            near, by = np.zeros(len(m)), np.zeros(len(m), np.int32)
            if len(found):
                s = m @ found.T
                by = s.argmax(axis=1).astype(np.int32)
                near = s[np.arange(len(m)), by]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(by), pa.array(near)], names=[*b.schema.names, "by", "near"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, x array<long>, ask boolean, by int, near double")


def index(rows: DataFrame, d: int) -> DataFrame:
    """One row per document range (``INDEX``) of (key, x, ask): ids and vectors, which rows are queries, and the term maxima."""
    def block(at: int, b: pa.RecordBatch) -> list:
        m = matrix(b.column("x"), d)
        ids = b.column("key").cast(pa.int64())
        return [at, ids.fill_null(LAST).to_numpy().tobytes(),
                b.column("ask").to_numpy(zero_copy_only=False).tobytes(), pack(m),
                pack(m.max(axis=0)[None, :]), pack(m.min(axis=0)[None, :])]

    kinds = [pa.int64()] + [pa.binary()] * 5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        at = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) < BLOCK:
                continue
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            full = t.num_rows // BLOCK * BLOCK
            for i in range(0, full, BLOCK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(block(at, t.slice(i, BLOCK)), kinds)], names=NAMES)
                at += 1
            held = [t.slice(full)] if full < t.num_rows else []
        if held:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(block(at, t), kinds)], names=NAMES)

    near = _placed(rows, d, pivots(rows, d))
    order = ["by", "near", "key", F.xxhash64("x")]
    return (near.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
            .select("key", "x", "ask").mapInArrow(run, INDEX))


def _ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def _flags(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, bool)


def query_rows(blocks: DataFrame, d: int, k: int) -> DataFrame:
    """(block, place, id, x, floor): the queries of each block; floor is the k-th best score among the other rows of
    the block (null: there are fewer), which the k-th best of all rows cannot fall below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                at = np.flatnonzero(_flags(r["asks"]))
                m = unpack(r["rows"], d)
                floor = [None] * len(at)
                if len(m) > k and len(at):
                    s = products(m[at], m)
                    s[np.arange(len(at)), at] = -LONG_MAX - 1
                    floor = np.partition(s, len(m) - k, axis=1)[:, len(m) - k].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"]] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(_ids(r["ids"])[at]),
                     pa.array([pack(m[i: i + 1]) for i in at], pa.binary()), pa.array(floor, pa.int64())],
                    names=["block", "place", "id", "x", "floor"])

    return blocks.select("block", "ids", "asks", "rows").mapInArrow(run, ASKED)


class Best:
    """The k best (score falling, id rising) of each query so far, and the score below which a row cannot be one."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.copy()
        self.who, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, who: list[np.ndarray], score: list[np.ndarray], ids: list[np.ndarray]) -> None:
        who, score, ids = (np.concatenate([old, *new]) for old, new in
                           ((self.who, who), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -1 - score, who))       # -1 - score cannot overflow
        who, score, ids = who[order], score[order], ids[order]
        first = np.searchsorted(who, who)
        rank = np.arange(len(who)) - first
        last = np.flatnonzero(rank == self.k - 1)
        self.floor[who[last]] = np.maximum(self.floor[who[last]], score[last])
        keep = (rank < self.k) & (score >= self.floor[who])
        self.who, self.score, self.id = who[keep], score[keep], ids[keep]


def search(blocks: DataFrame, queries: Broadcast, d: int, k: int) -> DataFrame:
    """(query_id, block, place, id, score): for each task and query of the group at most k rows, among them all rows of
    the task that are in the query's k best.  queries: (x matrix, id, block, place, floor)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, name, home, place, floor = queries.value
        best = Best(floor, k)

        def span(rows: list[dict]) -> None:
            bound = bounds(q, np.vstack([unpack(r["high"], d) for r in rows]),
                           np.vstack([unpack(r["low"], d) for r in rows]))
            order = np.argsort(-1 - bound, axis=1, kind="stable")
            live = np.arange(len(q))
            loaded: dict[int, tuple] = {}
            for turn in range(len(rows)):
                at = order[live, turn]
                go = bound[live, at] >= best.floor[live]
                live, at = live[go], at[go]
                if not len(live):
                    return
                got: tuple[list, list, list] = ([], [], [])
                for i in np.unique(at).tolist():
                    if i not in loaded:
                        loaded[i] = (unpack(rows[i]["rows"], d), _ids(rows[i]["ids"]))
                    m, ids = loaded[i]
                    who = live[at == i]
                    s = products(q[who], m)
                    fits = s >= best.floor[who][:, None]
                    own = np.flatnonzero(home[who] == rows[i]["block"])
                    fits[own, place[who[own]]] = False
                    a, c = np.nonzero(fits)
                    for to, part in zip(got, (who[a], s[a, c], ids[c])):
                        to.append(part)
                best.add(*got)

        held: list[dict] = []
        for b in batches:
            for r in b.to_pylist():
                held.append(r)
                if len(held) == SPAN:
                    span(held)
                    held = []
        if held:
            span(held)
        for i in range(0, len(best.who), 1 << 16):
            who = best.who[i: i + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (name[who], home[who], place[who], best.id[i: i + (1 << 16)],
                                       best.score[i: i + (1 << 16)])],
                names=["query_id", "block", "place", "id", "score"])

    return (blocks.select("block", "ids", "rows", "high", "low")
            .mapInArrow(run, FOUND))


FOUND = "query_id long, block long, place int, id long, score long"


def exact_topk(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", scale: int = 1024,
               k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row that ``is_query`` (over ``vectors``) picks the k rows
    of highest inner product of the quantised vectors (all, if fewer), its own row apart, ties to the smaller id.

    The key is an integer.  Vectors that are null or hold null or non-finite entries take no part; shorter ones count
    as padded with 0.  Rows of one id are rows of their own: each is a query, and a candidate of the others.  A null id
    is never a query; as a candidate it comes last among ties (the largest long counts as null).  An empty table gives
    no row; very long vectors cost memory of ``SPAN`` blocks a task.  Scores are exact; beyond long they
    stop at its limits.  Other columns are not read.
    """
    spark = vectors.sparkSession
    ask = F.coalesce(is_query, F.lit(False)) & F.col(key).isNotNull()
    rows = written(quantised(vectors, key, vector, scale, ask=ask), "quantised")
    d = max(1, width(rows))
    blocks = written(index(rows, d), "blocks")
    total, size = rows.where("ask").count(), max(1, GROUP_BYTES // (8 * d))
    n = 1 if total <= size else math.ceil(1.25 * total / size)       # groups by hash are uneven
    path, out = scratch_path(spark, "queries"), scratch_path(spark, "found")
    (query_rows(blocks, d, k).withColumn("part", F.pmod(F.xxhash64("block", "place"), F.lit(n)).cast("int"))
     .write.partitionBy("part").parquet(path))
    spark.createDataFrame([], FOUND).write.parquet(out)
    for part in range(n):
        mine = (spark.read.schema(f"{ASKED}, part int").parquet(path).where(F.col("part") == part).toArrow())
        if not mine.num_rows:
            continue
        sent = spark.sparkContext.broadcast((
            np.vstack([unpack(x, d) for x in mine["x"].to_pylist()]),
            *(mine[c].to_numpy() for c in ("id", "block", "place")),
            mine["floor"].combine_chunks().fill_null(-LONG_MAX - 1).to_numpy()))
        search(blocks, sent, d, k).write.mode("append").parquet(out)
        sent.unpersist()
    best = Window.partitionBy("block", "place").orderBy(F.col("score").desc(), "id")
    return (spark.read.schema(FOUND).parquet(out).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("id") != LAST, F.col("id")).alias("vec_id"), "score"))
