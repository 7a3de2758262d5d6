"""Mixing sources to target weights (8), DataFrame functions only: weighted fair queueing.

Every source is a queue of its documents in shuffled order, offered up to ``MOST`` times in turn.
A document's virtual finish time is the source's cumulative words divided by the source's target;
all documents are ordered by finish time and taken until the total budget (the sum of the targets) is
reached.  Cumulative sums are two-level: over the buckets of a source (a hot source has more buckets), then
within a bucket; the cut is found in a histogram of finish times and made exact in its one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.common import written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
ROWS_PER_BUCKET = 2048
TIMES = 4096                       # histogram cells per unit of finish time, up to four units
BLANKS = "\t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; null: 0."""
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("bigint")


def shuffle_key(key: str) -> Column:
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: source, rank (code point order, null last), rows, source_size, target.

    Targets share the total by weight; one that exceeds ``most`` times its source's size stops there and
    the excess is shared again by weight: target = min(most * size, level * weight), with the level at
    which the targets sum to the total.  One row per source; the ordered windows run over these rows.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("rank", F.row_number().over(by_name) - 1)
    cycle = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", cycle).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    per = per.withColumn("fill", F.col("cap") / F.col("weight"))
    order = Window.orderBy("fill", "rank")
    per = per.withColumns({
        "total": F.sum("source_size").over(Window.partitionBy()).cast("double"),
        "full": F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "open": F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    per = per.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    fits = F.when(F.col("level") <= F.col("fill"), F.struct("fill", "rank", "level"))
    per = per.withColumn("at", F.min(fits).over(Window.partitionBy()))
    return per.select("source", "rank", "rows", "source_size",
                      F.least("cap", F.coalesce("at.level", F.lit(0.0)) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per row: key, size (words), source_size, target (its source's), taken (words the mix takes,
    repeats counted; 0 to ``most`` times size).

    The order within a source is by md5 of the key, so reruns agree.  Null texts have size 0 and take
    nothing; a null source is a source; repeated rows are documents of their own; documents of equal
    finish time go by source, then order in it.  Other columns are not read.
    """
    sizes = written(docs.select(F.col(key).alias("key"), F.col(source).alias("source"),
                                word_count(F.col(text)).alias("size")), "sizes")
    targets = written(source_targets(sizes, weights, most), "targets")
    share = F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / float(2**32)
    pieces = F.ceil(F.col("rows") / ROWS_PER_BUCKET)
    rows = (sizes.withColumn("order", shuffle_key("key"))
            .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .withColumn("bucket", F.floor(share * pieces)))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("rank", "bucket").orderBy("order", "key", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    queued = written(
        rows.join(sums, ["rank", "bucket"]).withColumn("done", F.col("base") + F.sum("size").over(inside))
        .select("key", "order", "size", "rank", "source_size", "target", "done"), "queued")

    def finish(turn: Column) -> Column:
        return (turn * F.col("source_size") + F.col("done")) / F.col("target")

    def cell(time: Column) -> Column:
        return F.least(F.floor(time * TIMES), F.lit(4 * TIMES))

    offered = queued.where("size > 0 and target > 0").withColumn(
        "turn", F.explode(F.array(*(F.lit(i) for i in range(most))))).withColumn("time", finish(F.col("turn")))
    cells = offered.groupBy(cell(F.col("time")).alias("cell")).agg(F.sum("size").alias("n"))
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    budget = F.sum("n").over(upto)                                   # over at most 4 * TIMES + 1 rows
    total = sizes.agg(F.sum("size")).first()[0] or 0
    cut = (cells.select("cell", "n", budget.alias("sum")).where(F.col("sum") > total)
           .orderBy("cell").select("cell", (F.col("sum") - F.col("n")).alias("before")).first())
    at, spent = (cut["cell"], cut["before"]) if cut else (4 * TIMES + 1, 0)
    running = Window.orderBy("time", "rank", "order", "key", "turn").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    edge = (offered.where(cell(F.col("time")) == at)
            .withColumn("sum", F.lit(spent) + F.sum("size").over(running)).where(F.col("sum") <= total)
            .groupBy("rank", "done").agg(F.count("*").alias("more")))
    sure = sum((F.when(cell(finish(F.lit(i))) < at, 1).otherwise(0) for i in range(most)), F.lit(0))
    times = F.when((F.col("size") > 0) & (F.col("target") > 0), sure).otherwise(0)
    out = queued.join(edge, ["rank", "done"], "left").withColumn("times", times)
    more = F.when(F.col("size") > 0, F.coalesce("more", F.lit(0))).otherwise(0)
    return out.select(F.col("key").alias(key), "size", "source_size", "target",
                      (F.col("size") * (F.col("times") + more)).cast("bigint").alias("taken"))
