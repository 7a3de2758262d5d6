"""Ordering and splitting: seeded order (O1), dense positions without a single-partition window
(O4), union of corpora (U1), exact 70/10/20 split (U2) and the stateless stream split (U3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table

TEST_SIZE = 0.2      # first split: held-out test share (rounded up)
VAL_SIZE = 0.125     # second split: share of the remainder held out as validation (rounded up)
SEED = 1


def seeded_key(seed: int, *cols: str | Column) -> Column:
    """O1: a reproducible pseudo-random bigint per row: first 8 hex digits of
    ``md5('<seed>:<c1>:<c2>...')``.  Ties are broken by the row key afterwards."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                 for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")


def hash_key_buckets(key: str, n: int) -> Column:
    """Partition number (0..n-1) of a uniform 32-bit key (``seeded_key``), rising with it: no sampling needed."""
    return F.floor(F.col(key) * F.lit(n) / F.lit(4294967296)).cast("int")


def dense_position(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
                   out: str = "pos", total: str | None = None,
                   num_partitions: int | None = None, bucket: Column | None = None) -> DataFrame:
    """0-based rank of every row inside its ``by`` group by the (unique) ``order`` columns, as a prefix
    scan in two levels.

    1. Rows are dealt to ``num_partitions`` ordered partitions, sorted and written once to the shared folder
       with the number of their partition and their place in it.  With ``bucket`` (a Column of partition
       numbers that rises with ``order``, such as :func:`hash_key_buckets`) they go straight to that partition,
       else by ranges of (``by``, ``order``), which split a hot group by the next columns.
    2. Counts per (partition, group) are read from the written rows and summed over the partitions before;
       this table is written too and joined by the size it has: broadcast when small, else by a shuffle.

    Nothing goes through the driver and nothing is persisted: a lost executor reads the written rows again, and
    a task that is retried while writing commits its file once.  ``by`` may have any number of groups; null
    is a group of its own.  ``total`` adds the group size.  An empty input gives an empty result.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *by, *order) if bucket is None else df.repartitionById(n, bucket)
    rows = scratch_table(dealt.sortWithinPartitions(*by, *order)
                         .withColumn("_part", F.spark_partition_id())
                         .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
                         "positions")
    # one row per (partition, group); a group's rows of a partition lie together, the first at _first
    counts = rows.groupBy(*by, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.col("_part").alias("_at"),
        (F.coalesce(F.sum("_cnt").over(before), F.lit(0)) - F.col("_first")).alias("_off"),
        *([F.sum("_cnt").over(group).alias("_size")] if total else []))
    offsets = scratch_table(offsets, "offsets")
    same = F.col("_part") == F.col("_at")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_by{i}"))
    kept = [c for c in df.columns if c not in (out, total)]
    return rows.join(offsets, same).select(
        *kept, (F.col("_off") + F.col("_row")).alias(out), *([F.col("_size").alias(total)] if total else []))


def seeded_order(df: DataFrame, key_cols: Sequence[str], seed: int = SEED,
                 out: str = "pos", total: str | None = "n") -> DataFrame:
    """O1 + O4: dense position of every row in the seeded shuffle order."""
    keyed = df.withColumn("shuffle_key", seeded_key(seed, *key_cols))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dense_position(keyed, ["shuffle_key", *key_cols], out=out, total=total,
                          num_partitions=n, bucket=hash_key_buckets("shuffle_key", n))


def union_corpora(frames: dict[str, DataFrame], corpus_col: str = "corpus") -> DataFrame:
    """Concatenate corpora, duplicates kept; a corpus column and its index keep file order."""
    out = None
    for i, (name, frame) in enumerate(frames.items()):
        tagged = frame.withColumn(corpus_col, F.lit(name)).withColumn("corpus_idx", F.lit(i))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def split_sizes(n: Column, test_size: float = TEST_SIZE, val_size: float = VAL_SIZE):
    n_test = F.ceil(F.lit(test_size) * n)
    n_val = F.ceil(F.lit(val_size) * (n - n_test))
    return n_test, n_val


def exact_split(df: DataFrame, key_cols: Sequence[str], seed: int = SEED,
                test_size: float = TEST_SIZE, val_size: float = VAL_SIZE,
                out: str = "split", pos: str | None = None, total: str | None = None) -> DataFrame:
    """Exact sizes -- ceil(0.2 n) test, then ceil(0.125 of the rest) val, the rest train --
    over the seeded order.  One exchange of the rows; no global window.  ``pos`` and ``total`` add each row's place
    in its split and the split's size, which batches need (W1): both follow from the rank by arithmetic."""
    ordered = seeded_order(df, key_cols, seed=seed, out="_rank", total="_n")
    n_test, n_val = split_sizes(F.col("_n"), test_size, val_size)
    r = F.col("_rank")

    def by_split(test, val, train):
        return F.when(r < n_test, test).when(r < n_test + n_val, val).otherwise(train)

    more = {out: by_split(F.lit("test"), F.lit("val"), F.lit("train"))}
    if pos:
        more[pos] = by_split(r, r - n_test, r - n_test - n_val).cast("bigint")
    if total:
        more[total] = by_split(n_test, n_val, F.col("_n") - n_test - n_val).cast("bigint")
    return ordered.withColumns(more).drop("_rank", "_n", "shuffle_key")


def hash_split(df: DataFrame, key_cols: Sequence[str], seed: int = SEED, out: str = "split",
               test_per_mille: int = 200, val_per_mille: int = 300) -> DataFrame:
    """Stateless split for unbounded input: ``pmod(key, 1000)`` below 200 is test, below 300
    val, else train (expected 20/10/70).  Works on streaming frames."""
    bucket = F.pmod(seeded_key(seed, *key_cols), F.lit(1000))
    return df.withColumn(out, F.when(bucket < test_per_mille, "test")
                         .when(bucket < val_per_mille, "val").otherwise("train"))
