"""Pairing the two encoded sides of a corpus by row key.

The reference asserts that both sides have the same length and pairs them by list position; here
rows meet by key with an equi-join, and the check is a full outer join that keeps the keys present
on one side only.  Keys are unique per row, so neither join has a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_sides(src: DataFrame, tgt: DataFrame, key: str = "pair_id") -> DataFrame:
    """Inner equi-join of the source and target sides on ``key``."""
    return src.join(tgt, key)


def unmatched_sides(src: DataFrame, tgt: DataFrame, src_col: str, tgt_col: str,
                    key: str = "pair_id") -> DataFrame:
    """J1 check: keys found on one side only, with which side has them."""
    j = src.select(key, F.lit(True).alias("_s")).join(
        tgt.select(key, F.lit(True).alias("_t")), key, "full_outer")
    return j.where(F.col("_s").isNull() | F.col("_t").isNull()).select(
        key, F.col("_s").isNotNull().alias("has_" + src_col),
        F.col("_t").isNotNull().alias("has_" + tgt_col))


def assert_paired(src: DataFrame, tgt: DataFrame, key: str = "pair_id") -> None:
    """The reference's length assertion: raise when any key is on one side only."""
    bad = unmatched_sides(src, tgt, "src", "tgt", key).limit(5).collect()
    if bad:
        raise ValueError(f"sides are not paired, e.g. {[r[key] for r in bad]}")
