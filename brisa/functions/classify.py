"""Ordered rule classification."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A rule is (label, predicate builder). The builder receives a column resolver
# ``m(name) -> Column`` so the same rule list can be applied to columns with a
# prefix (``origin_``/``destination_``) or to bare observation columns.
Rule = tuple[str, Callable[[Callable[[str], Column]], Column]]

# The condition rules and their thresholds, in precedence order
# (first match wins): snow, storm, windy, fog, otherwise clear when an
# observation was matched.
WEATHER_RULES: list[Rule] = [
    ("snow", lambda m: m("snowfall") > 0),
    ("storm", lambda m: (m("wind_gusts_10m") > 20) & (m("surface_pressure") < 990)),
    ("windy", lambda m: (m("wind_speed_10m") > 10) | (m("wind_gusts_10m") > 15)),
    ("fog", lambda m: (m("relative_humidity_2m") > 90) & (m("cloud_cover") > 80)),
]
# Fixed value: label for a matched observation that meets no rule.
DEFAULT_LABEL = "clear"


def classify(
    rules: Sequence[Rule],
    matched: Column,
    resolve: Callable[[str], Column] = F.col,
    default_label: str = DEFAULT_LABEL,
) -> Column:
    """Chained ``CASE WHEN`` over ``rules``; ``default_label`` when ``matched``; else null.

    SQL three-valued logic applies: a rule whose predicate is null (a null
    measure) does not fire and evaluation falls through to the next rule.
    """
    expr = None
    for label, pred in rules:
        cond = pred(resolve)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    tail = F.lit(default_label)
    if expr is None:
        return F.when(matched, tail)
    return expr.when(matched, tail)


def prefixed(prefix: str) -> Callable[[str], Column]:
    """Resolver for measures carried with a name prefix, e.g. ``origin_``."""
    return lambda name: F.col(f"{prefix}{name}")
