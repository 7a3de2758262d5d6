"""Source divergence audit (11): a frequent-pattern tree of term rows.

Terms are counted per (lang, source) and kept if they are in ``LEAST`` documents of the lang.  A kept term is a row of
its nonzero counts in source order; the row is a path of items (source, count) and rows that are alike are one path with a
multiplicity.  Per lang and pair of sources a, b the sum over all V terms of f(p_a, p_b) is split by the smoothed
share of a count 0, z:

    V * f(z_a, z_b)                                            all terms, as if they occurred in neither
    + sum over a's terms of f(p_a, z_b) - f(z_a, z_b)          one product a distinct count of a; likewise b
    + sum over common terms of the pair correction f(p_a, p_b) - f(p_a, z_b) - f(z_a, p_b) + f(z_a, z_b)

Pair corrections come from the tree: each node (a prefix of paths) has the number of terms below it, and adds, for each of its
ancestors, one correction times that number, however many rows share the two.  Paths are range-partitioned
and sorted, so every task walks its part of the tree depth first, with only the open branch in memory; a prefix
that two tasks share is a node in both, which adds up to the same.  All numbers are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.common import partitions, slices, split_words, written

SCALE = 1_000_000_000
LEAST = 10                  # documents of the lang
TOP = 10                    # ranks of part ``term``
SPREAD = 4                  # leading items of a path that place it in a task
CHUNK = 1 << 19             # node-ancestor combinations computed at a time
LETTERS = np.ones(256, bool)              # [^\x00-\x40\x5B-\x60\x7B-\x7F]+ after lower-casing
LETTERS[:0x61] = False
LETTERS[0x7B:0x80] = False


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed per slice, then per task, then over all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            w = split_words(b.column("text"), LETTERS)
            if not len(w.codes):
                continue
            pairs = list(zip(b.column("lang").to_pylist(), b.column("source").to_pylist()))
            of = {g: i for i, g in enumerate(dict.fromkeys(pairs))}
            by = np.array([of[g] for g in pairs], np.int64)
            size = len(w.uniq)
            each, n = np.unique(np.repeat(np.arange(b.num_rows), w.counts()) * size + w.codes, return_counts=True)
            cell, at = np.unique(by[each // size] * size + each % size, return_inverse=True)     # each: (document, term)
            group = pa.array(cell // size)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([g[i] for g in of], pa.string()).take(group) for i in range(2)),
                 w.uniq.cast(pa.string()).take(pa.array(cell % size)),
                 pa.array(np.bincount(at, n).astype(np.int64)), pa.array(np.bincount(at))],
                names=["lang", "source", "term", "n", "docs"])

    plain = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n)
                          for c, n in ((text, "text"), (lang, "lang"), (source, "source"))))
    found = plain.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """p = 1 + floor(SCALE * (n + 2) / (N + 2 V)), exact; null where V is 0."""
    top = (n.cast("decimal(20,0)") + 2) * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + terms.cast("decimal(20,0)") * 2
    return 1 + F.call_function("div", top, F.nullif(below, F.lit(0).cast("decimal(1,0)")))


def divergence(p: Column, q: Column) -> Column:
    """f = floor((p - q)^2 / (p + q)); p and q are at most SCALE + 1, so squares stay within long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_cells(docs: DataFrame, text: str, lang: str, source: str, least: int) -> DataFrame:
    """(lang, source, term, n, whole, lead): the nonzero counts of the kept terms; whole is the term's count in the lang,
    lead is true in one cell of each term."""
    term = Window.partitionBy("lang", "term")               # one row a source at most
    return (term_counts(docs, text, lang, source)
            .withColumns({"whole": F.sum("n").over(term), "docs": F.sum("docs").over(term),
                          "lead": F.row_number().over(term.orderBy("source")) == 1})
            .where(F.col("docs") >= least).drop("docs"))


def _corrections(p: np.ndarray, z: np.ndarray, q: np.ndarray, y: np.ndarray) -> np.ndarray:
    def f(a, b):
        return (a - b) ** 2 // (a + b)
    return f(p, q) - f(p, y) - f(z, q) + f(z, y)


def pair_corrections(paths: DataFrame) -> DataFrame:
    """(lang, a, b, v) from paths (lang, path, m): path = [(at, n, p, z)] in source order, m its number of terms; a < b are
    places of sources in the lang, v the sum of m times the correction over all terms that both have."""
    item = np.dtype([("at", np.int64), ("p", np.int64), ("z", np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_lang: str | None = None
        branch = np.zeros(0, item)          # the open branch, root first
        below: list[int] = []               # number of terms below each of its nodes
        todo: list[tuple[int, np.ndarray, int]] = []
        size = 0

        def close(keep: int) -> None:
            """Leave the nodes deeper than ``keep``: each is complete and meets its ancestors once."""
            nonlocal size
            for depth in range(len(below) - 1, keep - 1, -1):
                if depth:
                    todo.append((depth, branch, below[depth]))
                    size += depth
                    below[depth - 1] += below[depth]
            del below[keep:]

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if todo:
                depths = np.array([t[0] for t in todo])
                own = np.array([t[1][t[0]] for t in todo], item)
                up = np.concatenate([t[1][:t[0]] for t in todo])
                down = np.repeat(own, depths)
                v = np.repeat(np.array([t[2] for t in todo], np.int64), depths)
                v = v * _corrections(down["p"], down["z"], up["p"], up["z"])
                pairs, at = np.unique(np.stack([up["at"], down["at"]]), axis=1, return_inverse=True)
                total = np.zeros(pairs.shape[1], np.int64)
                np.add.at(total, at.ravel(), v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([open_lang] * len(total), pa.string()), pa.array(pairs[0]), pa.array(pairs[1]), pa.array(total)],
                    names=["lang", "a", "b", "v"])
            todo.clear()
            size = 0

        for b in batches:
            path = b.column("path")
            ends = np.cumsum(path.value_lengths().to_numpy(zero_copy_only=False))
            flat = path.flatten()
            rows = np.zeros(len(flat), item)
            for f in item.names:
                rows[f] = flat.field(f).to_numpy(zero_copy_only=False)
            counts = flat.field("n").to_numpy(zero_copy_only=False)
            before, start = None, 0
            for lang, m, end in zip(b.column("lang").to_pylist(), b.column("m").to_pylist(), ends.tolist()):
                new, n = rows[start:end], counts[start:end]
                same = 0
                if lang != open_lang:
                    close(0)
                    yield from flush()
                    open_lang = lang
                elif below and before is not None:
                    most = min(len(before), len(n))
                    differ = np.flatnonzero((branch["at"][:most] != new["at"][:most]) | (before[:most] != n[:most]))
                    same = int(differ[0]) if len(differ) else most
                elif below:
                    close(0)                # the next batch opens its branch anew; the counts add up
                close(same)
                below += [0] * (len(new) - same)
                below[-1] += m
                branch, before, start = new, n, end
                if size > CHUNK:
                    yield from flush()
        close(0)
        yield from flush()

    head = F.transform(F.slice("path", 1, SPREAD), lambda x: F.struct(x["at"], x["n"]))
    spread = (paths.repartitionByRange(partitions(paths.sparkSession), F.col("lang"), head, F.xxhash64("path"))
              .sortWithinPartitions("lang", "path"))
    return (spread.mapInArrow(run, "lang string, a long, b long, v long")
            .groupBy("lang", "a", "b").agg(F.sum("v").alias("v")))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST,
          top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank per occurring (lang, source) group.

    Part ``pair``: a row for each other source of the lang, value the divergence of the two groups' smoothed term shares
    summed over the lang's kept terms (0 if there are none).  Part ``term``: the group's terms whose share is
    above the lang's, value their divergence from it, ranks up to ``top``.  Ranks are by falling value, then the item's bytes.

    Null text, lang and source are ''; groups without terms have their pairs; a lang of one source has no pair; repeated rows
    are documents of their own; an empty table gives no row; texts are read whole in slices, so long ones only
    cost their own size.  Other columns are not read.
    """
    every = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))))
    cells = written(kept_cells(docs, text, lang, source, least), "cells")
    used = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("lead").alias("terms"))
    of_lang = Window.partitionBy("lang")                     # one row a source
    groups = written(
        every.distinct().join(used, ["lang", "source"], "left").na.fill(0, ["total", "terms"])
        .withColumns({"terms": F.sum("terms").over(of_lang), "whole_total": F.sum("total").over(of_lang),
                      "at": F.row_number().over(of_lang.orderBy("source")).cast("long")})
        .withColumn("z", share(F.lit(0), F.col("total"), F.col("terms"))), "groups")
    marked = written(cells.join(groups, ["lang", "source"])
                     .withColumns({"p": share(F.col("n"), F.col("total"), F.col("terms")),
                                   "q": share(F.col("whole"), F.col("whole_total"), F.col("terms"))})
                     .select("lang", "source", "term", "at", "n", "p", "z", "q"), "marked")

    item = F.struct("at", "n", "p", "z")
    paths = (marked.groupBy("lang", "term").agg(F.array_sort(F.collect_list(item)).alias("path"))
             .groupBy("lang", "path").agg(F.count("*").alias("m")))
    common = written(pair_corrections(paths), "corrections")
    both = common.unionByName(
        common.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "v"))

    other = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), F.col("z").alias("y"))
    levels = marked.groupBy("lang", "at", "n", "p", "z").agg(F.count("*").alias("m"))
    gain = F.col("m") * (divergence(F.col("p"), F.col("y")) - divergence(F.col("z"), F.col("y")))
    single = written(
        levels.join(other.drop("item"), "lang").where("at <> b")
        .groupBy("lang", F.col("at").alias("a"), "b").agg(F.sum(gain).alias("v")), "singles")
    extra = (both.unionByName(single).unionByName(
        single.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "v"))
        .groupBy("lang", "a", "b").agg(F.sum("v").alias("v")))
    none = F.coalesce(F.col("terms") * divergence(F.col("z"), F.col("y")), F.lit(0))
    pairs = (groups.withColumnRenamed("at", "a").join(other, "lang").where("a <> b")
             .join(extra, ["lang", "a", "b"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     (none + F.coalesce("v", F.lit(0))).alias("value")))

    above = marked.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = F.row_number().over(order)
    return (pairs.withColumn("rank", ranked)
            .unionByName(above.withColumn("rank", ranked).where(F.col("rank") <= top)))
