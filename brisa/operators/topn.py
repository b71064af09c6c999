"""Ordering and top-k (O1, O2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, measure: str, n: int, tie_keys: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """The ``n`` best rows by ``measure``, ties broken by ``tie_keys`` (O2).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every task keeps
    its own top ``n`` and only those are merged, so there is no full sort.
    Nulls in the measure sort last.
    """
    m = F.col(measure).asc_nulls_last() if ascending else F.col(measure).desc_nulls_last()
    return df.orderBy(m, *[F.col(k).asc_nulls_last() for k in tie_keys]).limit(n)


def total_order(df: DataFrame, keys: Sequence[str], descending: Sequence[bool] | None = None) -> DataFrame:
    """Range-partitioned global sort (O1)."""
    descending = descending or [False] * len(keys)
    cols = [F.col(k).desc_nulls_last() if d else F.col(k).asc_nulls_last() for k, d in zip(keys, descending)]
    return df.orderBy(*cols)
