"""Dimension models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import month_start, quarter_start, sunday_week
from ..operators.joins import with_membership_flag
from ..operators.windows import first_per_key, mode_per_key
from ..sources import lookups


def dim_place(places: DataFrame, hubs: DataFrame) -> DataFrame:
    """Places with a hub flag."""
    return with_membership_flag(places, "station", hubs, "station", "is_hub")


def dim_carrier(carriers: DataFrame, order_col: str = "carrier_id") -> DataFrame:
    """One row per carrier code: the lowest id wins."""
    return first_per_key(carriers, "carrier", order_col)


def dim_asset(stg: DataFrame) -> DataFrame:
    """Most frequent (registration, type) per asset id (C9, W3; trap T11)."""
    src = stg.filter(F.col("asset_id").isNotNull()).select("asset_id", "asset_registration", "asset_type")
    return mode_per_key(src, "asset_id", ["asset_registration", "asset_type"]).drop("obs_count")


def calendar_attributes(spine: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar attributes of each day.

    Day of week counts from Sunday = 1; the week number starts on Sunday with
    days before the first Sunday in week 0.
    """
    d = F.col(day).cast("date")
    return spine.select(
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter_of_year"),
        F.month(d).alias("month"),
        sunday_week(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        month_start(d).alias("month_start_date"),
        quarter_start(d).alias("quarter_start_date"),
    )


def dim_date(spark: SparkSession, start: str = "2019-01-01", end_exclusive: str = "2023-01-01") -> DataFrame:
    """Date dimension over a fixed window."""
    return calendar_attributes(lookups.date_spine(spark, start, end_exclusive))


def dim_event(spark: SparkSession) -> DataFrame:
    """Condition categories (C11)."""
    return lookups.events(spark)


def dim_phase(spark: SparkSession, base_year: int = 2019) -> DataFrame:
    """Shock phases."""
    return lookups.phases(spark, base_year)
