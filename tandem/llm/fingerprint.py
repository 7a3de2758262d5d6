"""Document fingerprints (3), DataFrame functions only: bottom-k sketches of shingle hashes.

The sketch of a text is the sorted ``k`` smallest distinct 64-bit hashes of its 5-word shingles (a text
of fewer words, but not none, is one shingle).  Sketches of parts merge into the sketch of the whole.
All functions take and return columns of ``array<bigint>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.functions.arrays import let
from tandem.llm.common import partitions

KEEP, SHINGLE = 128, 5
BLANKS = " \t\n\x0b\f\r"
MOST_BUCKETS = 4096
_SPAN = float(2**64)


def sketch(text: Column, k: int = KEEP) -> Column:
    empty = F.array().cast("array<bigint>")

    def shingles(h: Column) -> Column:
        run = [h[0]]
        return F.when(F.size(h) >= SHINGLE, F.transform(
            F.sequence(F.lit(0), F.size(h) - SHINGLE),
            lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(SHINGLE))))).otherwise(
            F.array(F.xxhash64(F.size(h), *run, *(F.coalesce(F.get(h, F.lit(j)), F.lit(0)) for j in range(1, SHINGLE)))))

    def of(t: Column) -> Column:
        words = F.split(t, "[ \\t\\n\\x0B\\f\\r]+")
        hashes = F.transform(words, lambda w: F.xxhash64(w))
        return F.when(t == "", empty).otherwise(
            F.slice(F.sort_array(F.array_distinct(let(hashes, shingles))), 1, k))

    return let(F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)), of)


def merge(a: Column, b: Column, k: int = KEEP) -> Column:
    """Sketch of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = KEEP) -> Column:
    """Estimated Jaccard similarity (exact below k shingles); two empty sets: 1."""
    return let(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)))


def distinct_shingles(a: Column, k: int = KEEP) -> Column:
    """Estimated number of distinct shingles (exact below k)."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(
        (k - 1) / ((F.get(a, F.lit(k - 1)).cast("double") + _SPAN / 2) / _SPAN))


def containment(a: Column, b: Column, k: int = KEEP) -> Column:
    """Estimated part of a's shingles that b has; an empty a: 1."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(
        F.lit(1.0), resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k) / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """The sketch as 16 hexadecimal digits per hash."""
    return F.lower(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def with_next(docs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Every row with ``next``: the struct of ``fields`` of the row that follows in ascending key order
    (nulls first, equal keys by the fields); after the last row the first.

    Rows are put into buckets of key ranges (bounds from approximate quantiles, at most
    ``MOST_BUCKETS``); the first rows of each bucket also go, as guests, to the end of the bucket
    before, so one shuffle and a window within buckets give every row its follower.
    """
    at = F.coalesce(F.col(key).cast("bigint"), F.lit(-(2**63)))
    n = min(partitions(docs.sparkSession), MOST_BUCKETS)
    shares = [i / n for i in range(1, n)]
    ids = docs.select(at.alias("_at"))
    row = ids.agg(F.percentile_approx("_at", shares or [0.5], 10000).alias("b")).first()
    bounds = sorted(set(row["b"] or []))
    steps = [1 << i for i in reversed(range(max(1, len(bounds).bit_length())))]
    limits = F.array(*(F.lit(b) for b in bounds)).cast("array<bigint>")

    def bucket(x: Column) -> Column:
        return F.aggregate(F.array(*(F.lit(s) for s in steps)), F.lit(0), lambda acc, s: acc + F.when(
            F.coalesce(F.get(limits, acc + s - 1) <= x, F.lit(False)), s).otherwise(0))

    first = sorted((r["b"], r["f"]) for r in ids.groupBy(bucket(F.col("_at")).alias("b"))
                   .agg(F.min("_at").alias("f")).collect())            # one row per bucket
    if not first:
        kinds = ", ".join(f"{c}: {docs.schema[c].dataType.simpleString()}" for c in fields)
        return docs.withColumn("next", F.lit(None).cast("struct<" + kinds.replace(": ", ":") + ">"))
    own = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("guest"), F.lit(0).alias("turn"))
    homes = F.array(own)
    before = {f: (first[i - 1][0], int(i == 0)) for i, (_, f) in enumerate(first)}
    guests = F.create_map(*(x for f, (b, turn) in before.items() for x in (
        F.lit(f), F.struct(F.lit(b).alias("b"), F.lit(True).alias("guest"), F.lit(turn).alias("turn")))))
    homes = F.when(F.map_contains_key(guests, F.col("_at")),
                   F.array(own, F.element_at(guests, F.col("_at")))).otherwise(homes)
    spread = (docs.withColumn("_at", at).withColumn("_bucket", bucket(F.col("_at")))
              .withColumn("_home", F.explode(homes)))
    order = Window.partitionBy("_home.b").orderBy("_home.turn", "_home.guest", "_at", *fields)
    return (spread.withColumn("next", F.lead(F.struct(*fields)).over(order))
            .where(~F.col("_home.guest")).drop("_at", "_bucket", "_home"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = KEEP) -> DataFrame:
    """Per row: key, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_shingles (estimated), contained (estimated part of the text's shingles in the edited text).

    The edited text is the text with its last floor(n_chars / 4) code points replaced by the first as
    many (or all) of the next row's text in ascending key order (after the last: the first).  Null texts
    are empty; the fingerprint of a text without words is empty; two empty ones are alike (1.0).
    Repeated rows follow each other.  Other columns are not read.
    """
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("fp", sketch(F.col("text"), k))
    rows = with_next(rows, key, ["text", "fp"])
    cut = F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 4) as int))"),
                      F.substring(F.col("next.text"), F.lit(1), cut))
    rows = rows.select(key, "text", "fp", F.col("next.fp").alias("next_fp"), edited.alias("edited"))
    rows = rows.select(key, F.char_length("text").cast("bigint").alias("n_chars"), "fp", "next_fp",
                       F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), k).alias("edited_fp"))
    return rows.select(
        key, "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        resemblance(F.col("fp"), F.col("edited_fp"), k).alias("near_edited"),
        resemblance(F.col("fp"), F.col("next_fp"), k).alias("near_next"),
        distinct_shingles(F.col("fp"), k).alias("n_shingles"),
        containment(F.col("fp"), F.col("edited_fp"), k).alias("contained"))
