"""Aggregation operators.

Everything is a ``groupBy().agg()`` with aggregates that support map-side
partial aggregation (count, sum, avg, stddev, percentile sketch), so a hot
group is combined inside each task before the shuffle and never lands whole
in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Relative accuracy of the percentile sketch: 1/accuracy. At the default the
# sketch is exact for groups of up to several thousand values.
DEFAULT_PERCENTILE_ACCURACY = 10_000


def collapse_duplicates(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per key with the mean of every measure.

    Guarantees the right side of a bucket join is unique on its keys.
    """
    return df.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in measures])


def profile_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float] = (0.5, 0.95),
    names: Sequence[str] | None = None,
    digits: int | None = 2,
    count_name: str = "total_movements",
    prefix: str = "",
    accuracy: int = DEFAULT_PERCENTILE_ACCURACY,
) -> DataFrame:
    """Count, mean, sample stddev and quantiles of ``value`` per group.

    Quantiles come from ``percentile_approx`` (a mergeable sketch with partial
    aggregation), which returns an observed value like a discrete quantile.
    """
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])

    def rnd(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c

    q = F.percentile_approx(F.col(value), list(probs), accuracy)
    aggs = [
        F.count(F.lit(1)).alias(count_name),
        rnd(F.avg(value)).alias(f"avg_{prefix}{value}"),
        rnd(F.stddev_samp(value)).alias(f"stddev_{prefix}{value}"),
        q.alias("__q"),
    ]
    out = df.groupBy(*keys).agg(*aggs)
    for i, n in enumerate(names):
        out = out.withColumn(f"{n}_{prefix}{value}", rnd(F.col("__q").getItem(i)))
    return out.drop("__q")


def avg_of_counts(
    df: DataFrame,
    inner_keys: Sequence[str | Column],
    outer_keys: Sequence[str],
    outer_aggs: Sequence[Column],
    count_name: str = "n",
) -> DataFrame:
    """Count per fine grain, then aggregate those counts per coarse grain.

    ``outer_aggs`` refer to ``count_name`` and to inner key columns.
    """
    inner = df.groupBy(*inner_keys).agg(F.count(F.lit(1)).alias(count_name))
    return inner.groupBy(*outer_keys).agg(*outer_aggs)


def group_count(df: DataFrame, keys: Sequence[str | Column], name: str = "n") -> DataFrame:
    """``group by keys`` + ``count(*)``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
