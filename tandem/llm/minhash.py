"""MinHash near-dedup (6): circulant MinHash, banding, exact Jaccard verification, components.

Two permutations of the 64-bit ring make all ``COORDS`` coordinates: shingles are placed by the first, and
coordinate k is the minimum of the second, circularly shifted by k.  ``ROWS`` of the first ``BANDED``
coordinates make a band (``BANDS`` bands); at a similarity of 0.75 a pair misses all bands with probability
5e-6.

Equal shingle sets are one class first (128-bit fingerprint); links are sought between classes only and no
group is ever expanded into all its pairs:

* round 1 links every member of a group of the first ``FIRST_BANDS`` bands to the group's smallest member;
* round 2 looks at the groups of all bands that still hold several components.  Groups of up to ``SMALL``
  members compare the members of different components; larger groups are first split by one of the
  next ``PARTNERS`` bands (a pair at 0.75 shares two bands so close with probability 0.999), and what is
  still large after that is linked to the members of its smallest and its largest component;
* round 3 looks at the groups over ``SMALL`` members, as they were before the split, that hold several components
  even now: every member outside the group's most frequent component is compared with every member, in blocks of
  about ``BLOCK_ROWS`` rows.  So the split loses no pair, it only leaves fewer components to round 3.

Candidates must agree in ``AGREE`` of the coordinates, of which rows carry the last four bits (different
minima agree by chance in 1 of 16; at 0.75: 4.4 standard deviations below the mean, missed with probability 1e-5), and in size, and their counts of shingles per hash bucket must leave room for
the intersection (an upper bound, so nothing is missed by it); every link is then confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import SPACE_WORDS, mix64, partitions, shingle_hashes, slices, split_words, written

SHINGLE = 5
COORDS, BANDED, ROWS = 512, 128, 4
BANDS = BANDED // ROWS
NEEDED, OUT_OF = 75, 100
SMALL = 256
BLOCK_ROWS = 2048
BUCKETS, FULL = 256, 15
HALVES = COORDS + BUCKETS       # four-bit fields of a signature, two a byte
FIRST_BANDS, PARTNERS = 8, 8
AGREE = 350
SLOTS = 1 << 22
BLOCK = 1 << 14
PLACE, ODD1, ODD2 = 0x51ED270B, np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each document joined, bounds)."""
    w = split_words(texts, SPACE_WORDS)
    h, bounds = shingle_hashes(w.hashes()[w.codes], w.doc, n)
    for s, e in zip(bounds[:-1], bounds[1:]):
        h[s:e].sort()
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[keep], np.searchsorted(owner[keep], np.arange(len(bounds)))


def signatures(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """[documents, COORDS] minima; documents without shingles get the largest value."""
    n = len(bounds) - 1
    out = np.full((COORDS, n), np.uint64(2**64 - 1))
    placed = mix64(h, PLACE)
    v, t = np.empty(BLOCK, np.uint64), np.empty(BLOCK, np.uint64)
    for s in range(0, len(h), BLOCK):
        e = min(s + BLOCK, len(h))
        first = int(np.searchsorted(bounds, s, side="right")) - 1
        starts = np.append(s, np.unique(bounds[first + 1: -1][bounds[first + 1: -1] < e]))
        docs = np.searchsorted(bounds, starts, side="right") - 1
        a, b, x = v[: e - s], t[: e - s], placed[s:e]
        for k in range(COORDS):
            np.add(x, np.uint64(k), out=a)
            np.multiply(a, ODD1, out=a)
            np.right_shift(a, np.uint64(32), out=b)
            np.bitwise_xor(a, b, out=a)
            np.multiply(a, ODD2, out=a)
            out[k, docs] = np.minimum(out[k, docs], np.minimum.reduceat(a, starts - s))
    return out.T


def band_keys(sig: np.ndarray) -> np.ndarray:
    """[documents, BANDS] 64-bit keys; the band number is part of the key."""
    h = np.broadcast_to(mix64(np.arange(BANDS, dtype=np.uint64), 5), (len(sig), BANDS)).copy()
    rows = sig[:, :BANDED].reshape(len(sig), BANDS, ROWS)
    for k in range(ROWS):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k], 11 + k)
    return h.view(np.int64)


def _sign(docs: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            h, bounds = shingle_sets(b.column(text))
            sig = signatures(h, bounds)
            n = np.diff(bounds)
            raw = h.tobytes()
            fp = [xxhash.xxh3_128_digest(raw[8 * s: 8 * e]) if e > s else None
                  for s, e in zip(bounds[:-1], bounds[1:])]
            keys = pa.array(band_keys(sig).ravel())
            small = packed(np.hstack([(sig & np.uint64(15)).astype(np.uint8), bucket_counts(h, bounds)]))
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array(n.astype(np.int64)), pa.array(fp, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * BANDS, pa.int32()), keys),
                 pa.array([r.tobytes() for r in small], pa.binary())],
                names=[key, "n_shingles", "fp", "bands", "sig"])

    return docs.select(key, text).mapInArrow(
        run, f"{key} {kind}, n_shingles long, fp binary, bands array<long>, sig binary")


def bucket_counts(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """[documents, BUCKETS] shingles per hash bucket, FULL standing for FULL and more."""
    n = len(bounds) - 1
    at = np.repeat(np.arange(n) * BUCKETS, np.diff(bounds)) + (h & np.uint64(BUCKETS - 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=n * BUCKETS), FULL).astype(np.uint8).reshape(n, BUCKETS)


def packed(fields: np.ndarray) -> np.ndarray:
    """Rows of four-bit fields, two a byte."""
    return fields[:, ::2] | fields[:, 1::2] << 4


#: Equal four-bit fields of two bytes, by their exclusive or.
SAME = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)


def may_be_linked(x: np.ndarray, y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray) -> np.ndarray:
    """Which pairs of rows (coordinates, then bucket counts, packed) of n_x and n_y shingles pass the filters."""
    c = COORDS // 2
    ok = SAME[x[:, :c] ^ y[:, :c]].sum(axis=1, dtype=np.int64) >= AGREE
    at = np.flatnonzero(ok)
    p, q = x[at, c:], y[at, c:]
    low = np.hstack([np.minimum(p & 15, q & 15), np.minimum(p >> 4, q >> 4)])
    both = low.sum(axis=1, dtype=np.int64)                       # at least the intersection, unless FULL
    ok[at] = (low == FULL).any(axis=1) | (OUT_OF * both >= NEEDED * (n_x[at] + n_y[at] - both))
    return ok


def _slot(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int")


def _sets_of(docs: DataFrame, wanted: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    """node, set (sorted shingle hashes) of the wanted classes (node, fp).  Only documents whose key falls
    into a bitmap of fixed size are shingled again; the join decides."""
    used = wanted.select(_slot(F.col("node")).alias("s")).distinct().toPandas()["s"]
    slots = np.zeros(SLOTS, bool)
    slots[used.to_numpy(np.int64)] = True                            # at most SLOTS rows
    spread = docs.sparkSession.sparkContext.broadcast(np.packbits(slots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(spread.value).astype(bool)

        def some() -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = b.column("slot").to_numpy(zero_copy_only=False)
                yield b.filter(pa.array(bits[at]))

        for b in slices(some(), text):
            h, bounds = shingle_sets(b.column(text))
            raw = h.tobytes()
            sets = [raw[8 * s: 8 * e] for s, e in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()),
                 pa.array(sets, pa.binary())], names=["node", "fp", "set"])

    got = (docs.where(F.col(key).isNotNull()).select(key, text, _slot(F.col(key)).alias("slot"))
           .mapInArrow(run, f"node {kind}, fp binary, set binary"))
    return got.join(wanted, ["node", "fp"], "left_semi").dropDuplicates(["node", "fp"]).select("node", "set")


def _confirm(joined: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[at] == p).sum())
                keep.append(OUT_OF * both >= NEEDED * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays(
                [b.column("a").filter(pa.array(keep, pa.bool_())), b.column("b").filter(pa.array(keep, pa.bool_()))],
                names=["a", "b"])

    kinds = dict(joined.dtypes)
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(run, f"a {kinds['a']}, b {kinds['b']}")


def _alike(joined: DataFrame) -> DataFrame:
    """Pairs whose sizes and signatures allow a similarity of 0.75."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, HALVES // 2)
                    for c in ("sig_a", "sig_b"))
            keep = pa.array(may_be_linked(x, y, b.column("n_a").to_numpy(), b.column("n_b").to_numpy()), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    kinds = dict(joined.dtypes)
    return joined.select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(run, f"a {kinds['a']}, b {kinds['b']}")


def _fits(n_a: str, n_b: str) -> Column:
    return F.least(n_a, n_b) * OUT_OF >= F.greatest(n_a, n_b) * NEEDED


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass the filters of size and signature."""
    facts = classes.select("node", "n", "sig")
    return _alike(pairs.join(facts.toDF("a", "n_a", "sig_a"), "a").join(facts.toDF("b", "n_b", "sig_b"), "b")
                  .where(_fits("n_a", "n_b")))


def _links(docs: DataFrame, near: DataFrame, classes: DataFrame, key: str, text: str, kind: str,
           name: str) -> DataFrame:
    """Filtered pairs (a < b, distinct) confirmed on full sets."""
    near = written(near, f"{name}_near")
    ids = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    sets = written(_sets_of(docs, classes.select("node", "fp").join(ids, "node"), key, text, kind), f"{name}_sets")
    joined = (near.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b"))
    return written(_confirm(joined), f"{name}_links")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): smallest node reachable, for every node with a link.  Each step points nodes at
    their smallest neighbour, follows the pointers to their ends and contracts the links."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    found = written(ends.select("node", F.col("node").alias("comp")), "comp")
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select("b", "a"))
        up = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p"))
                     .select("node", F.least("node", "p").alias("p")), "up")
        while True:
            jump = up.toDF("p", "q")
            new = written(up.join(jump, "p").select("node", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), "up")
            up = new.select("node", "p")
            if new.where("moved").isEmpty():
                break
        found = written(found.join(up.toDF("comp", "p"), "comp", "left")
                        .select("node", F.coalesce("p", "comp").alias("comp")), "comp")
        links = (links.join(up.toDF("a", "pa"), "a").join(up.toDF("b", "pb"), "b").where("pa != pb")
                 .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        links = written(links, "contracted")
    return found


def _pairs_in_groups(rows: DataFrame, n: int) -> DataFrame:
    """Pairs of different components within groups or blocks of bounded size; rows: key, node, comp, n,
    sig, tag (the group's band, or band and partner), tags and keys (of all such groups of the node).  Groups meet by a hash of their key and are read in order, all pairs of a batch at once.  A pair
    that several groups hold is emitted by the group of its first common tag alone."""
    kind = dict(rows.dtypes)["node"]

    def emit(t: pa.Table) -> pa.RecordBatch:
        key = t["key"].to_numpy()
        node, comp, size = (t[c].to_numpy() for c in ("node", "comp", "n"))
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, HALVES // 2)
        tag, tags = t["tag"].to_numpy(), t["tags"].combine_chunks()
        held = np.zeros((len(key), BANDS * (1 + PARTNERS)), np.int64)      # 0: not in such a group
        held[np.repeat(np.arange(len(key)), tags.value_lengths().to_numpy()), tags.flatten().to_numpy()] = (
            t["keys"].combine_chunks().flatten().to_numpy())
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.repeat(np.append(starts[1:], len(key)), np.diff(np.append(starts, len(key))))
        out_a, out_b = [], []
        for step in count(1):
            i = np.flatnonzero(np.arange(len(key)) + step < ends)
            if len(i) == 0:
                break
            j = i + step
            ok = (comp[i] != comp[j]) & (np.minimum(size[i], size[j]) * OUT_OF >= np.maximum(size[i], size[j]) * NEEDED)
            i, j = i[ok], j[ok]
            for s in range(0, len(i), 1 << 13):
                p, q = i[s: s + (1 << 13)], j[s: s + (1 << 13)]
                near = np.flatnonzero(may_be_linked(sig[p], sig[q], size[p], size[q]))
                common = (held[p[near]] == held[q[near]]) & (held[p[near]] != 0)
                near = near[common.argmax(axis=1) == tag[p[near]]] if len(near) else near
                out_a.append(np.minimum(node[p[near]], node[q[near]]))
                out_b.append(np.maximum(node[p[near]], node[q[near]]))
        a = np.concatenate(out_a) if out_a else np.zeros(0, node.dtype)
        b = np.concatenate(out_b) if out_b else np.zeros(0, node.dtype)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            if t.num_rows == 0:
                continue
            key = t["key"].to_numpy()
            last = int(np.searchsorted(key, key[-1]))      # the last group may go on
            rest = t.slice(last)
            if last:
                yield emit(t.slice(0, last).combine_chunks())
        if rest is not None and rest.num_rows:
            yield emit(rest.combine_chunks())

    return (rows.select("key", "node", "comp", "n", "sig", "tag", "tags", "keys").repartition(n, "key").sortWithinPartitions("key", "node")
            .mapInArrow(run, f"a {kind}, b {kind}").distinct())


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (key, node, comp, ..) of groups that hold several components, with the group's size m."""
    groups = (rows.groupBy("key").agg(F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                      F.min(F.struct("comp", "node"))["node"].alias("lo_node"),
                                      F.max(F.struct("comp", "node"))["node"].alias("hi_node"))
              .where("lo < hi"))
    return rows.join(groups, "key")


def _tags(rows: DataFrame) -> DataFrame:
    """node, tags and keys of all its groups: at most one key per tag."""
    return (rows.groupBy("node").agg(F.collect_set(F.struct("tag", "key")).alias("g"))
            .select("node", F.col("g.tag").alias("tags"), F.col("g.key").alias("keys")))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (key, node, comp, tag) of large groups as rows of blocks: a block holds some members outside the
    group's most frequent component and some of all its members; every such pair meets in a block."""
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("c"))
    groups = sizes.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("m")).select(
        "key", F.col("top.comp").alias("top"), F.ceil((F.col("m") - F.col("top.c")) / BLOCK_ROWS).alias("xs"),
        F.ceil(F.col("m") / BLOCK_ROWS).alias("ys"))
    rows = (rows.select("key", "node", "comp", "tag").join(groups, "key")
            .withColumn("x", F.pmod(F.xxhash64("node", F.lit(1)), "xs"))
            .withColumn("y", F.pmod(F.xxhash64("node", F.lit(2)), "ys")))
    every = rows.withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("xs") - 1)))
    others = (rows.where("comp != top and ys > 1").withColumnRenamed("y", "own")
              .withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ys") - 1))).where("y != own"))
    cols = [F.xxhash64("key", "x", "y").alias("key"), "node", "comp", "tag"]
    return every.select(*cols).union(others.select(*cols))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable over links of Jaccard
    similarity >= 0.75 of 5-word shingle sets, the own included), kept (key = component_id).

    Words: ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; fewer than five words: the whole sequence is the one
    shingle; no words or no text: an empty set, linked with nothing.  Repeated rows have the same component; a
    row with a null key takes its class's component (null if it has no other member) and is kept only then.
    Other columns are not read.
    """
    n, kind = partitions(docs.sparkSession), docs.schema[key].dataType.simpleString()
    signed = written(_sign(docs, key, text, kind), "signed")
    classes = written(
        signed.where("fp is not null").groupBy("fp")
        .agg(F.min(key).alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
             F.first("sig").alias("sig")).where("node is not null"), "classes")
    members = classes.select("node", F.posexplode("bands").alias("band", "key"))
    groups = members.groupBy("key").agg(F.count("*").alias("m"), F.min("node").alias("center")).where("m > 1")
    members = written(members.join(groups, "key"), "members")
    star = members.where((F.col("band") < FIRST_BANDS) & (F.col("node") != F.col("center"))).select(
        F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    first = _links(docs, _near(star, classes), classes, key, text, kind, "round1")
    comp = components(first)

    def with_comp(rows: DataFrame) -> DataFrame:
        return rows.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    facts = classes.select("node", "n", "sig")
    mixed = written(_mixed(with_comp(members.select("key", "band", "node"))), "mixed")
    large = mixed.where(F.col("m") > SMALL)
    ring = F.concat("bands", "bands")
    second = (large.select("key", "band", "node", "comp").join(classes.select("node", "bands"), "node")
              .select("node", "comp", "key", "band", F.posexplode(
                  F.slice(ring, F.col("band") + 2, F.lit(PARTNERS))).alias("turn", "other"))
              .select("node", "comp", F.xxhash64("key", "other").alias("key"),
                      (BANDS + F.col("band") * PARTNERS + F.col("turn")).alias("tag")))
    second = written(_mixed(second), "split_groups")
    small = (mixed.where(F.col("m") <= SMALL).select("key", "node", "comp", F.col("band").alias("tag"))
             .union(second.where(F.col("m") <= SMALL).select("key", "node", "comp", "tag")))
    pairs = _pairs_in_groups(small.join(facts.join(_tags(small), "node"), "node"), n)
    still = second.where(F.col("m") > SMALL)
    edges = [still.where(F.col("comp") != F.col(c)).select(
        F.least("node", f"{c}_node").alias("a"), F.greatest("node", f"{c}_node").alias("b")) for c in ("lo", "hi")]
    pairs = written(pairs.union(_near(edges[0].union(edges[1]).distinct(), classes)).distinct(), "pairs")   # all filtered
    more = _links(docs, pairs.join(star, ["a", "b"], "left_anti"), classes, key, text, kind, "round2")
    if not more.isEmpty():
        comp = components(first.union(more))
    rest = written(_mixed(with_comp(large.select("key", "node", F.col("band").alias("tag")))), "rest")
    if not rest.isEmpty():
        blocks = _blocks(rest).join(facts.join(_tags(rest), "node"), "node")
        untried = _pairs_in_groups(blocks, n).join(star.union(pairs), ["a", "b"], "left_anti")
        last = _links(docs, untried, classes, key, text, kind, "round3")
        if not last.isEmpty():
            comp = components(first.union(more).union(last))
    out = signed.select(key, "n_shingles", "fp").join(classes.select("fp", "node"), "fp", "left")
    out = out.join(comp, "node", "left").withColumn(
        "component_id", F.when(F.col("fp").isNull(), F.col(key)).otherwise(F.coalesce("comp", "node")))
    return out.select(key, "n_shingles", "component_id",
                      F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
