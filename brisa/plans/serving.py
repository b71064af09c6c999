"""Serving queries over the marts.

These read the small marts (hub x month x event, pair, carrier x month), so
their joins to the place and carrier dimensions are the only joins left; the
dimension side is joined without hints and the planner sizes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import DEFAULT_LABEL
from ..functions.conditional import cond_avg, pearson, weighted_avg
from ..functions.scalars import safe_divide
from ..operators.joins import restrict_to_top
from ..operators.sketches import roll_up_distinct, roll_up_quantiles
from ..operators.topn import top_n


def _places(dim_place: DataFrame) -> DataFrame:
    return dim_place.select(F.col("station").alias("__ps"), "place_name", "country")


def cross_stress(
    recovery: DataFrame, resilience: DataFrame, dim_place: DataFrame, recovery_year: int = 2022, clear: str = DEFAULT_LABEL
) -> DataFrame:
    """Shock and condition resilience score per hub.

    shock_resilience: mean recovery ratio in ``recovery_year``.
    weather_resilience: 1 - relative excess of the movement-weighted mean
    duration under non-clear conditions over clear conditions.
    """
    shock = recovery.groupBy("hub").agg(cond_avg(F.col("year") == recovery_year, "recovery_ratio").alias("recovery_avg"))
    is_clear = F.col("event") == clear
    weather = resilience.groupBy("hub").agg(
        weighted_avg("avg_duration_minutes", "total_movements", ~is_clear).alias("bad_duration"),
        weighted_avg("avg_duration_minutes", "total_movements", is_clear).alias("clear_duration"),
    )
    j = shock.join(weather, "hub").join(_places(dim_place), F.col("hub") == F.col("__ps"))
    return j.select(
        "place_name",
        "country",
        "hub",
        F.round("recovery_avg", 3).alias("shock_resilience"),
        F.round(
            F.lit(1.0) - safe_divide(F.col("bad_duration") - F.col("clear_duration"), F.col("clear_duration")), 3
        ).alias("weather_resilience"),
    ).orderBy(F.col("shock_resilience").desc_nulls_last(), F.col("hub"))


def stress_correlation(scores: DataFrame) -> DataFrame:
    """Pearson correlation of the two scores, rounded to 2 places."""
    return scores.agg(F.round(pearson("weather_resilience", "shock_resilience"), 2).alias("r"))


def hub_condition_profile(resilience: DataFrame, dim_place: DataFrame) -> DataFrame:
    """Movements and weighted mean duration per hub and event."""
    j = resilience.join(_places(dim_place), F.col("hub") == F.col("__ps"))
    return (
        j.groupBy("hub", "place_name", "event")
        .agg(
            F.sum("total_movements").alias("total_movements"),
            F.round(weighted_avg("avg_duration_minutes", "total_movements"), 1).alias("avg_duration_minutes"),
        )
        .orderBy("hub", "event")
    )


def resilience_by_period(sketches: DataFrame, unit: str = "year") -> DataFrame:
    """Movements, mean, p50 and p95 of duration per hub, period and event, merged from the stored monthly sketches (A5, M4 -> M11).

    No movement is read again. A quantile's rank is within ``sketches.rank_error()``
    of the group's rows; groups of up to ``SKETCH_SIZE`` movements are exact.
    """
    start = F.trunc("month", unit).alias("period")
    out = roll_up_quantiles(sketches, ["hub", start, "event"])
    return out.select(
        "hub",
        "period",
        "event",
        F.col("rows").alias("total_movements"),
        F.round("mean", 2).alias("avg_duration_minutes"),
        F.round("p50", 2).alias("p50_duration_minutes"),
        F.round("p95", 2).alias("p95_duration_minutes"),
    )


def active_days_by_period(bitmaps: DataFrame, unit: str = "year") -> DataFrame:
    """Exact number of days with a movement per hub, period and event, OR-ed from the stored monthly bitmaps."""
    return roll_up_distinct(bitmaps, ["hub", F.trunc("month", unit).alias("period"), "event"], "active_days")


def carrier_trajectory(perf: DataFrame, dim_carrier: DataFrame, n: int = 12) -> DataFrame:
    """Monthly series of the ``n`` largest carriers with display name."""
    top = restrict_to_top(perf, "carrier", "total_flights", n)
    names = dim_carrier.select(F.col("carrier").alias("__c"), F.col("carrier_name").alias("__name"))
    j = top.join(names, F.col("carrier") == F.col("__c"), "left")
    return j.select(
        "carrier",
        F.coalesce(F.col("__name"), F.col("carrier")).alias("carrier_name"),
        "month",
        "year",
        "total_flights",
        "traffic_recovery_ratio",
    ).orderBy("carrier", "month")


def hub_series(recovery: DataFrame, dim_place: DataFrame) -> DataFrame:
    """Hub recovery series with place name."""
    j = recovery.join(_places(dim_place), F.col("hub") == F.col("__ps"))
    return j.select(
        "hub", "place_name", "month", "year", "total_movements", "baseline_movements", "recovery_ratio", "phase"
    ).orderBy("hub", "month")


def top_routes(risk: DataFrame, n: int = 200) -> DataFrame:
    """Busiest base-year pairs with both indices present."""
    ok = risk.dropna(subset=["weather_sensitivity_index", "shock_sensitivity_index"])
    ok = ok.select(
        "origin",
        "destination",
        F.concat(F.col("origin").cast("string"), F.lit(" -> "), F.col("destination").cast("string")).alias("route"),
        "total_flights_base",
        "weather_sensitivity_index",
        "shock_sensitivity_index",
    )
    return top_n(ok, "total_flights_base", n, tie_keys=["origin", "destination"])


def recovery_ranking(series: DataFrame, year: int = 2022) -> DataFrame:
    """Mean recovery ratio per place in one year, ranked."""
    return (
        series.filter(F.col("year") == year)
        .groupBy("place_name")
        .agg(F.round(F.avg("recovery_ratio"), 3).alias("recovery_avg"))
        .orderBy(F.col("recovery_avg").desc_nulls_last(), "place_name")
    )


def condition_mix(profile: DataFrame) -> DataFrame:
    """Total movements per event, ranked."""
    return (
        profile.groupBy("event")
        .agg(F.sum("total_movements").alias("movements"))
        .orderBy(F.col("movements").desc(), "event")
    )


def most_sensitive(risk: DataFrame, n: int = 15) -> DataFrame:
    """Pairs with the highest condition sensitivity."""
    r = risk.select(
        F.concat(F.col("origin").cast("string"), F.lit(" -> "), F.col("destination").cast("string")).alias("route"),
        "total_flights_base",
        "weather_sensitivity_index",
    )
    return top_n(r, "weather_sensitivity_index", n, tie_keys=["route"])


def score_table(scores: DataFrame) -> DataFrame:
    """Score table projection, ranked by shock resilience."""
    return scores.select("place_name", "country", "weather_resilience", "shock_resilience").orderBy(
        F.col("shock_resilience").desc_nulls_last(), "place_name"
    )
