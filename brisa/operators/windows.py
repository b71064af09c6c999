"""Per-key row selection.

``row_number() = 1`` filters are planned by Spark with a WindowGroupLimit on
both sides of the shuffle: each task keeps only its best row per key before
exchanging, so even a key holding a large share of the rows sends at most one
row per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _total_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_break: Sequence[str] | None):
    """Append tie-break columns so the chosen row never depends on task order."""
    if tie_break is None:
        used = set(keys)
        tie_break = [f.name for f in df.schema.fields if f.name not in used and f.dataType.typeName() not in ("array", "map", "struct")]
    return list(order) + [F.col(c).asc_nulls_first() for c in tie_break]


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Keep one row per key: the first under ``order`` (W1), fully tie-broken (T4)."""
    w = Window.partitionBy(*keys).orderBy(*_total_order(df, keys, order, tie_break))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def first_per_key(df: DataFrame, key: str, order_col: str, tie_break: Sequence[str] | None = None) -> DataFrame:
    """Keep the row with the smallest ``order_col`` per key."""
    return dedup_latest(df, [key], [F.col(order_col).asc_nulls_last()], tie_break)


def mode_per_key(df: DataFrame, key: str, attrs: Sequence[str], count_name: str = "obs_count") -> DataFrame:
    """Most frequent attribute tuple per key (W3); ties go to the smallest tuple.

    The tuples are counted with a partial aggregate first, so the window sees
    one row per distinct (key, tuple).
    """
    counted = df.groupBy(key, *attrs).agg(F.count(F.lit(1)).alias(count_name))
    order = [F.col(count_name).desc()] + [F.col(a).asc_nulls_first() for a in attrs]
    w = Window.partitionBy(key).orderBy(*order)
    return counted.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
