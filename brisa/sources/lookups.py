"""Static lookups and date spines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PHASE_SCHEMA = T.StructType(
    [
        T.StructField("phase", T.StringType(), False),
        T.StructField("phase_start_date", T.DateType(), False),
        T.StructField("phase_end_date", T.DateType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("sort_order", T.IntegerType(), False),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("sort_order", T.IntegerType(), False),
    ]
)

# The four shock phases (name, first day, last day, description,
# display order) for a base year of 2019.
PHASES_2019 = [
    ("pre_shock", "2019-01-01", "2019-12-31", "Full 2019 baseline year before pandemic", 1),
    ("collapse", "2020-01-01", "2020-06-30", "Initial pandemic collapse and lockdown period, Q1-Q2 2020", 2),
    ("restricted", "2020-07-01", "2021-12-31", "Partial recovery under ongoing restrictions, H2 2020 through 2021", 3),
    ("recovery", "2022-01-01", "2022-12-31", "Post-restriction recovery, full year 2022", 4),
]

# Condition categories (name, description, display order).
EVENTS = [
    ("clear", "Minimal precipitation and low wind", 1),
    ("windy", "Wind speed > 10 m/s or gusts > 15 m/s", 2),
    ("snow", "Snowfall > 0 cm", 3),
    ("fog", "Relative humidity > 90% and cloud cover > 80% (visibility proxy)", 4),
    ("storm", "Wind gusts > 20 m/s and surface pressure < 990 hPa", 5),
]


def phase_rows(base_year: int) -> list[tuple]:
    """The four phases laid out relative to ``base_year`` (2019 gives ``PHASES_2019``).

    pre_shock: the base year; collapse: first half of the next year;
    restricted: from mid next year to the end of the year after; recovery: the
    third year after the base.
    """
    b = base_year
    return [
        ("pre_shock", f"{b}-01-01", f"{b}-12-31", f"Full {b} baseline year before the shock", 1),
        ("collapse", f"{b + 1}-01-01", f"{b + 1}-06-30", f"Initial collapse, first half of {b + 1}", 2),
        ("restricted", f"{b + 1}-07-01", f"{b + 2}-12-31", f"Partial recovery, H2 {b + 1} through {b + 2}", 3),
        ("recovery", f"{b + 3}-01-01", f"{b + 3}-12-31", f"Post-restriction recovery, full year {b + 3}", 4),
    ]


def lookup(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small literal table (S14). ISO date strings are converted for DATE fields."""
    conv = []
    for r in rows:
        out = []
        for v, f in zip(r, schema.fields):
            if isinstance(f.dataType, T.DateType) and isinstance(v, str):
                v = dt.date.fromisoformat(v)
            out.append(v)
        conv.append(tuple(out))
    return spark.createDataFrame(conv, schema)


def phases(spark: SparkSession, base_year: int = 2019) -> DataFrame:
    """Phase lookup."""
    rows = PHASES_2019 if base_year == 2019 else phase_rows(base_year)
    return lookup(spark, rows, PHASE_SCHEMA)


def events(spark: SparkSession) -> DataFrame:
    """Condition lookup (C11)."""
    return lookup(spark, EVENTS, EVENT_SCHEMA)


def date_spine(spark: SparkSession, start: str, end_exclusive: str) -> DataFrame:
    """One row per day in ``[start, end_exclusive)``."""
    return spark.range(1).select(
        F.explode(
            F.sequence(
                F.lit(start).cast("date"),
                F.date_sub(F.lit(end_exclusive).cast("date"), 1),
                F.expr("interval 1 day"),
            )
        ).alias("date_day")
    )


def date_spine_between(bounds: DataFrame, start: Column | str, end_inclusive: Column | str) -> DataFrame:
    """Date spine whose bounds come from a one-row frame computed by Spark."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end_inclusive) if isinstance(end_inclusive, str) else end_inclusive
    return bounds.select(F.explode(F.sequence(s.cast("date"), e.cast("date"), F.expr("interval 1 day"))).alias("date_day"))
