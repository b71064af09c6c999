"""Conditional and weighted aggregate expressions.

Each returns an aggregate ``Column`` for use inside ``groupBy().agg()`` so the
whole set of measures of a grain is computed in one pass with map-side
partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnOrName, _col, safe_divide


def cond_avg(pred: Column, value: ColumnOrName) -> Column:
    """``avg(case when pred then value end)``."""
    return F.avg(F.when(pred, _col(value)))


def cond_sum(pred: Column, value: ColumnOrName) -> Column:
    """``sum(case when pred then value end)``."""
    return F.sum(F.when(pred, _col(value)))


def cond_count_distinct(pred: Column, value: ColumnOrName) -> Column:
    """``count(distinct case when pred then value end)``."""
    return F.count_distinct(F.when(pred, _col(value)))


def count_where(pred: Column) -> Column:
    """``countif(pred)`` (A6); null predicates do not count."""
    return F.count_if(pred)


def share(pred: Column, digits: int | None = 4) -> Column:
    """``countif(pred) / count(*)`` optionally rounded (A10)."""
    out = safe_divide(F.count_if(pred), F.count(F.lit(1)))
    return F.round(out, digits) if digits is not None else out


def weighted_avg(value: ColumnOrName, weight: ColumnOrName, pred: Column | None = None) -> Column:
    """``sum(value * weight) / sum(weight)``, optionally restricted by a predicate."""
    v, w = _col(value), _col(weight)
    if pred is not None:
        return safe_divide(F.sum(F.when(pred, v * w)), F.sum(F.when(pred, w)))
    return safe_divide(F.sum(v * w), F.sum(w))


def pearson(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation that is null, not an error, for fewer than two rows or a
    constant input (A13).

    ``corr`` divides by the product of the standard deviations and raises under
    ANSI arithmetic when one is zero; the sample covariance over the product of
    sample standard deviations is the same ratio with a null-safe division.
    """
    xc, yc = _col(x).cast("double"), _col(y).cast("double")
    return F.try_divide(F.covar_samp(xc, yc), F.stddev_samp(xc) * F.stddev_samp(yc))
