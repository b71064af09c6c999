"""Quantiles and distinct counts that can be added up (A5, A9): stored per fine group, merged to any coarser one.

A quantile sketch (KLL) of a group is a few kilobytes whatever the group's size;
merging sketches of months gives the sketch of the year, within the same rank
error as if the year's rows had been sketched. Distinct counts over a dense
whole-number key are exact: a group holds a bitmap per 32,768 consecutive
numbers that occur, bitmaps are OR-ed upward, and their set bits are counted.
Both are aggregates with partial results, so a hot group is reduced inside each
task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size parameter of the sketch: groups of up to this many values are kept exactly.
SKETCH_SIZE = 2048


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Stated error of a quantile's rank, as a share of the group's rows, at 99 % confidence (DataSketches' formula for KLL)."""
    return 2.296 / size**0.9723


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """Per group: ``rows`` (values that are not null), ``total`` (their sum) and ``sketch``."""
    v = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.count(v).alias("rows"), F.sum(v).alias("total"), F.kll_sketch_agg_double(v, size).alias("sketch"))


def roll_up_quantiles(
    sketches: DataFrame,
    keys: Sequence[str | Column],
    probs: Sequence[float] = (0.5, 0.95),
    names: Sequence[str] | None = None,
    size: int = SKETCH_SIZE,
    keep: bool = False,
) -> DataFrame:
    """Merge stored sketches to coarser ``keys``: ``rows``, ``mean`` and one column per quantile; with ``keep`` the merged sketch too.

    A quantile is the smallest value whose share of values up to it reaches the
    probability. Groups without values have null quantiles and mean.
    """
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    merged = sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch", size).alias("sketch")
    )
    some = F.col("rows") > 0
    out = merged.withColumn("mean", F.when(some, F.col("total") / F.col("rows")))
    for p, n in zip(probs, names, strict=True):
        out = out.withColumn(n, F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))))
    return out if keep else out.drop("sketch", "total")


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Per group and stretch of 32,768 numbers: ``bucket`` and ``bits``, a bit for each whole number that occurs.

    For dense numbers, such as days or dictionary codes from 0 on; nulls are not counted.
    """
    n = F.col(number).cast("long") + 1
    return df.filter(F.col(number).isNotNull()).groupBy(*keys, F.bitmap_bucket_number(n).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits")
    )


def roll_up_distinct(bitmaps: DataFrame, keys: Sequence[str | Column], name: str = "distinct") -> DataFrame:
    """Exact number of distinct numbers per coarser group, from stored bitmaps."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    outer = [c for c in merged.columns if c not in ("bucket", "bits")]
    return merged.groupBy(*outer).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(name))
