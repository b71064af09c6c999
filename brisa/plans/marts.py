"""Conditions join and marts.

Input is the standard movement frame of ``staging.stg_movements``. Hubs are a
frame with a ``station`` column (a top-N result or a seed); where its size is
small the planner broadcasts it and the facts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import DEFAULT_LABEL, WEATHER_RULES, Rule, classify, prefixed
from ..functions.conditional import cond_avg, count_where, share
from ..functions.scalars import between_dates, in_year, month_start, safe_divide
from ..operators.aggregates import collapse_duplicates, profile_stats
from ..operators.joins import (
    baseline_join,
    full_outer_counts,
    hot_buckets,
    range_lookup,
    time_bucket_join,
    touches_any,
    with_membership_flag,
)
from ..operators.sets import movements
from ..operators.sketches import distinct_bitmaps, quantile_sketches
from ..operators.topn import top_n

# The measures averaged per station and hour before the join.
WEATHER_MEASURES = [
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "wind_gusts_10m",
    "precipitation",
    "snowfall",
    "cloud_cover",
    "surface_pressure",
]


@dataclass(frozen=True)
class Calendar:
    """Base year and shock window used by the baseline and sensitivity marts."""

    base_year: int = 2019
    collapse_start: str = "2020-01-01"
    collapse_end: str = "2020-06-30"
    recovery_year: int = 2022

    @classmethod
    def from_base(cls, base_year: int) -> Calendar:
        b = base_year
        return cls(b, f"{b + 1}-01-01", f"{b + 1}-06-30", b + 3)


def rank_hubs(
    raw_flights: DataFrame,
    places: DataFrame,
    countries: Sequence[str],
    year: int,
    n: int,
    date_col: str = "day",
    origin: str = "origin",
    destination: str = "destination",
    place_key: str = "station",
    country_col: str = "country",
    place_cols: Sequence[str] = ("station_iata", "place_name", "country", "latitude", "longitude"),
) -> DataFrame:
    """Top ``n`` stations by base-year movements within a country set.

    One pass over the facts: each row yields its origin and destination,
    counted per station with map-side partial aggregation; the ranking is a
    TakeOrderedAndProject, never a full sort.
    """
    if dict(raw_flights.dtypes)[date_col] == "string":
        in_base = raw_flights.filter(F.col(date_col).between(f"{year:04d}-", f"{year:04d}-~"))
    else:  # a range on the column itself reaches the Parquet reader
        in_base = raw_flights.filter(in_year(date_col, year))
    ends = in_base.select(F.explode(F.array(F.col(origin), F.col(destination))).alias("station"))
    counts = ends.filter(F.col("station").isNotNull()).groupBy("station").agg(F.count(F.lit(1)).alias("total_movements"))
    scoped = places.filter(F.col(country_col).isin(list(countries))).select(
        F.col(place_key).alias("__pk"), *[F.col(c) for c in place_cols]
    )
    joined = counts.join(scoped, F.col("station") == F.col("__pk"), "inner").drop("__pk")
    return top_n(joined, "total_movements", n, tie_keys=["station"]).select("station", *place_cols, "total_movements")


def observation_grid(obs: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row per (station, observation hour), measures averaged."""
    return collapse_duplicates(obs, ["station", "observation_hour"], measures)


def movements_with_conditions(
    stg: DataFrame,
    observations: DataFrame,
    hubs: DataFrame,
    measures: Sequence[str] = WEATHER_MEASURES,
    rules: Sequence[Rule] = WEATHER_RULES,
    split_hot: bool = False,
) -> DataFrame:
    """Hub-touching movements with the observation at both ends.

    Origin end: (origin, hour of first_seen_at). Destination end:
    (destination, hour of last_seen_at). Each end is classified with the
    ordered rules; an end with no observation gets a null event (T5). With
    ``split_hot`` two more passes over a station and a time column look for
    (station, hour) pairs that hold many movements and split them; for grids too
    large to broadcast.
    """
    facts = touches_any(
        stg.select(
            "movement_id",
            "callsign",
            "carrier",
            "flight_number",
            "asset_id",
            "asset_type",
            "origin",
            "destination",
            "movement_date",
            "first_seen_at",
            "last_seen_at",
            "duration_minutes",
        ),
        ["origin", "destination"],
        hubs,
        "station",
    )
    grid = observation_grid(observations, measures)
    hot = [hot_buckets(facts, *end) if split_hot else None for end in (("origin", "first_seen_at"), ("destination", "last_seen_at"))]
    out = time_bucket_join(facts, grid, "origin", "first_seen_at", measures, "origin_", hot=hot[0])
    out = out.withColumn("origin_event", classify(rules, F.col("origin_matched"), prefixed("origin_")))
    out = time_bucket_join(out, grid, "destination", "last_seen_at", measures, "destination_", hot=hot[1])
    out = out.withColumn("destination_event", classify(rules, F.col("destination_matched"), prefixed("destination_")))
    return out.drop("origin_matched", "destination_matched")


def traffic_baseline(stg: DataFrame, hubs: DataFrame, base_year: int = 2019) -> DataFrame:
    """Departures, arrivals and total per hub and month of the base year (M2).

    One pass: each movement yields its hub ends (broadcast semi-join), counted
    per direction in one aggregate. Equivalent to the full outer join of the
    two counts (``baseline_by_full_outer``) without scanning twice.
    """
    base = stg.filter(between_dates("movement_date", f"{base_year}-01-01", f"{base_year}-12-31"))
    ends = movements(
        base,
        [{"hub": "origin"}, {"hub": "destination"}],
        carry=["movement_date"],
        hubs=hubs,
        hub_key="station",
    )
    return ends.groupBy("hub", month_start("movement_date").alias("month")).agg(
        F.count_if(F.col("end_index") == 0).alias("departures_base"),
        F.count_if(F.col("end_index") == 1).alias("arrivals_base"),
        F.count(F.lit(1)).alias("total_base"),
    )


def baseline_by_full_outer(stg: DataFrame, hubs: DataFrame, base_year: int = 2019) -> DataFrame:
    """M2 in the two-count shape: departures and arrivals, full outer joined."""
    base = stg.filter(between_dates("movement_date", f"{base_year}-01-01", f"{base_year}-12-31"))
    h = hubs.select(F.col("station").alias("__h"))
    month = month_start("movement_date").alias("month")
    dep = base.join(h, F.col("origin") == F.col("__h")).groupBy(F.col("origin").alias("hub"), month).agg(
        F.count(F.lit(1)).alias("departures_base")
    )
    arr = base.join(h, F.col("destination") == F.col("__h")).groupBy(F.col("destination").alias("hub"), month).agg(
        F.count(F.lit(1)).alias("arrivals_base")
    )
    return full_outer_counts(dep, arr, ["hub", "month"], "departures_base", "arrivals_base", "total_base")


def recovery(cond: DataFrame, hubs: DataFrame, baseline: DataFrame, phase_lookup: DataFrame) -> DataFrame:
    """Monthly hub movements against the same calendar month of the base year (M3).

    A base-year month is compared with itself (ratio 1.0, trap T9). Phase is
    found by a broadcast range join on the month start (J6).
    """
    ends = movements(cond, [{"hub": "origin"}, {"hub": "destination"}], carry=["movement_date"], hubs=hubs)
    monthly = ends.groupBy("hub", month_start("movement_date").alias("month")).agg(
        F.count(F.lit(1)).alias("total_movements")
    )
    base = baseline.select("hub", F.month("month").alias("calendar_month"), F.col("total_base").alias("baseline_movements"))
    j = baseline_join(monthly, base, ["hub"], "month", "calendar_month", ["baseline_movements"])
    j = range_lookup(j, "month", phase_lookup.select("phase", "phase_start_date", "phase_end_date"), "phase_start_date", "phase_end_date", literal=True)
    return j.select(
        "hub",
        "month",
        F.year("month").alias("year"),
        F.month("month").alias("calendar_month"),
        "total_movements",
        "baseline_movements",
        F.round(safe_divide("total_movements", "baseline_movements"), 4).alias("recovery_ratio"),
        (F.col("total_movements") - F.coalesce(F.col("baseline_movements"), F.lit(0))).alias("movement_delta"),
        "phase",
    )


def resilience_profile(cond: DataFrame, hubs: DataFrame, unknown_as: str = DEFAULT_LABEL) -> DataFrame:
    """Count, mean, stddev, p50 and p95 of duration per hub, month and event (M4).

    An end with no observation counts as ``unknown_as`` (T5).
    """
    return profile_stats(_hub_ends(cond, hubs, unknown_as), ["hub", "month", "event"], "duration_minutes")


# Day 0 of the day bitmaps.
FIRST_DAY = "1900-01-01"


def _hub_ends(cond: DataFrame, hubs: DataFrame, unknown_as: str) -> DataFrame:
    ends = movements(
        cond,
        [{"hub": "origin", "event": "origin_event"}, {"hub": "destination", "event": "destination_event"}],
        carry=["movement_date", "duration_minutes"],
        hubs=hubs,
    )
    return ends.select(
        "hub",
        month_start("movement_date").alias("month"),
        F.coalesce(F.col("event"), F.lit(unknown_as)).alias("event"),
        "movement_date",
        "duration_minutes",
    )


def resilience_sketches(cond: DataFrame, hubs: DataFrame, unknown_as: str = DEFAULT_LABEL) -> DataFrame:
    """Mergeable duration sketch per hub, month and event (A5): what ``resilience_profile`` tells, in a form that adds up.

    A few kilobytes per group are stored instead of rows, and any coarser
    profile comes from them (``serving.resilience_by_period``).
    """
    ends = _hub_ends(cond, hubs, unknown_as)
    return quantile_sketches(ends, ["hub", "month", "event"], "duration_minutes")


def hub_day_bitmaps(cond: DataFrame, hubs: DataFrame, unknown_as: str = DEFAULT_LABEL) -> DataFrame:
    """Per hub, month and event a bitmap of the days with a movement (A9), so that distinct days add up to any coarser group."""
    ends = _hub_ends(cond, hubs, unknown_as)
    return distinct_bitmaps(ends.withColumn("day", F.datediff("movement_date", F.lit(FIRST_DAY).cast("date"))), ["hub", "month", "event"], "day")


def _pair_daily(cond: DataFrame, end: str, unknown_as: str, hubs: DataFrame | None) -> DataFrame:
    """Daily movement counts per (origin, destination, date, event at ``end``) (A12 inner level)."""
    f = cond if hubs is None else touches_any(cond, ["origin", "destination"], hubs, "station")
    f = f.select(
        "origin",
        "destination",
        "movement_date",
        F.coalesce(F.col(f"{end}_event"), F.lit(unknown_as)).alias("hub_event"),
    )
    return f.groupBy("origin", "destination", "movement_date", "hub_event").agg(F.count(F.lit(1)).alias("daily_flights"))


def condition_sensitivity(
    cond: DataFrame,
    calendar: Calendar = Calendar(),
    min_flights: int = 12,
    end: str = "origin",
    unknown_as: str = DEFAULT_LABEL,
    hubs: DataFrame | None = None,
    daily: DataFrame | None = None,
) -> DataFrame:
    """Condition sensitivity per origin-destination pair.

    (clear - bad) / clear of the average daily count in the base year. The
    daily grain includes the event, so a mixed day counts on both sides, and
    days without movements never enter an average (T7). Only ``end``'s event
    is used (T6). Pairs need ``min_flights`` in the base year.
    """
    daily = daily if daily is not None else _pair_daily(cond, end, unknown_as, hubs)
    clear = F.col("hub_event") == unknown_as
    bad = F.col("hub_event") != unknown_as
    base = daily.filter(in_year("movement_date", calendar.base_year))
    # One row per pair and day first: days with clear (bad) movements are then a plain sum, not a distinct count.
    by_day = base.groupBy("origin", "destination", "movement_date").agg(
        F.sum(F.when(clear, F.col("daily_flights"))).alias("clear_sum"),
        F.sum(F.when(bad, F.col("daily_flights"))).alias("bad_sum"),
        F.count_if(clear).alias("clear_rows"),
        F.count_if(bad).alias("bad_rows"),
    )
    weather = (
        by_day.groupBy("origin", "destination")
        .agg(
            safe_divide(F.sum("clear_sum"), F.sum("clear_rows")).alias("avg_flights_clear"),
            safe_divide(F.sum("bad_sum"), F.sum("bad_rows")).alias("avg_flights_bad"),
            F.count_if(F.col("clear_rows") > 0).alias("clear_days_base"),
            F.count_if(F.col("bad_rows") > 0).alias("bad_days_base"),
            (F.coalesce(F.sum("clear_sum"), F.lit(0)) + F.coalesce(F.sum("bad_sum"), F.lit(0))).alias("total_flights_base"),
        )
        .filter(F.col("total_flights_base") >= min_flights)
    )
    return weather.withColumn(
        "weather_sensitivity_index",
        F.round(safe_divide(F.col("avg_flights_clear") - F.col("avg_flights_bad"), F.col("avg_flights_clear")), 4),
    )


def shock_sensitivity(
    cond: DataFrame,
    calendar: Calendar = Calendar(),
    end: str = "origin",
    unknown_as: str = DEFAULT_LABEL,
    hubs: DataFrame | None = None,
    daily: DataFrame | None = None,
) -> DataFrame:
    """Shock sensitivity per pair: (base - collapse) / base of the average monthly count.

    Monthly counts are re-summed from the daily counts, so the facts are
    aggregated once even when M5 and M6 are computed together. A pair with no
    movement in the collapse window gets a null index, not 1 (T7).
    """
    daily = daily if daily is not None else _pair_daily(cond, end, unknown_as, hubs)
    monthly = daily.groupBy("origin", "destination", month_start("movement_date").alias("month")).agg(
        F.sum("daily_flights").alias("monthly_flights")
    )
    shock = monthly.groupBy("origin", "destination").agg(
        cond_avg(in_year("month", calendar.base_year), "monthly_flights").alias("avg_monthly_base"),
        cond_avg(between_dates("month", calendar.collapse_start, calendar.collapse_end), "monthly_flights").alias(
            "avg_monthly_collapse"
        ),
    )
    return shock.withColumn(
        "shock_sensitivity_index",
        F.round(safe_divide(F.col("avg_monthly_base") - F.col("avg_monthly_collapse"), F.col("avg_monthly_base")), 4),
    )


def route_risk(
    cond: DataFrame,
    calendar: Calendar = Calendar(),
    min_flights: int = 12,
    end: str = "origin",
    unknown_as: str = DEFAULT_LABEL,
    hubs: DataFrame | None = None,
) -> DataFrame:
    """Condition and shock sensitivity per pair: M5 inner join M6 (M7).

    Both sides derive from one daily aggregate of the facts (the repeated
    exchange is reused by the planner) and are grouped by the pair they are
    joined on.
    """
    daily = _pair_daily(cond, end, unknown_as, hubs)
    w = condition_sensitivity(cond, calendar, min_flights, end, unknown_as, daily=daily)
    s = shock_sensitivity(cond, calendar, end, unknown_as, daily=daily)
    return w.join(s, ["origin", "destination"], "inner").select(
        "origin",
        "destination",
        "total_flights_base",
        "avg_flights_clear",
        "avg_flights_bad",
        "clear_days_base",
        "bad_days_base",
        "weather_sensitivity_index",
        "avg_monthly_base",
        "avg_monthly_collapse",
        "shock_sensitivity_index",
    )


def carrier_performance(
    cond: DataFrame, hubs: DataFrame, base_year: int = 2019, unknown_as: str = DEFAULT_LABEL
) -> DataFrame:
    """Monthly carrier performance against its own base-year calendar month (M8).

    Hub concentration is the share of movements touching a hub; for C6 input
    it is 1 by construction (T10), for any other fact set it is informative.
    """
    f = cond.filter(F.col("carrier").isNotNull())
    f = with_membership_flag(f, "origin", hubs, "station", "__oh")
    f = with_membership_flag(f, "destination", hubs, "station", "__dh")
    f = f.select(
        "carrier",
        month_start("movement_date").alias("month"),
        "duration_minutes",
        (F.col("__oh") | F.col("__dh")).alias("touches_hub"),
        F.coalesce(F.col("origin_event"), F.lit(unknown_as)).alias("event"),
    )
    clear = F.col("event") == unknown_as
    monthly = f.groupBy("carrier", "month").agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.round(F.avg("duration_minutes"), 2).alias("avg_duration_minutes"),
        F.round(F.stddev_samp("duration_minutes"), 2).alias("stddev_duration_minutes"),
        share(F.col("touches_hub"), 4).alias("hub_concentration_ratio"),
        count_where(clear).alias("clear_flights"),
        F.round(cond_avg(clear, "duration_minutes"), 2).alias("avg_duration_clear"),
        F.round(cond_avg(F.col("event") != unknown_as, "duration_minutes"), 2).alias("avg_duration_bad"),
    )
    # Base-year average of the same calendar month, as a window over the small
    # monthly aggregate: one pass, where a self-join on the aggregate would make
    # the planner scan the facts a second time with fewer columns.
    same_month = Window.partitionBy("carrier", F.month("month"))
    base_avg = F.avg(F.when(in_year("month", base_year), F.col("total_flights"))).over(same_month)
    return monthly.select(
        "carrier",
        "month",
        F.year("month").alias("year"),
        "total_flights",
        "avg_duration_minutes",
        "stddev_duration_minutes",
        "hub_concentration_ratio",
        "clear_flights",
        "avg_duration_clear",
        "avg_duration_bad",
        base_avg.alias("baseline_avg_flights"),
        F.round(safe_divide(F.col("total_flights"), base_avg), 4).alias("traffic_recovery_ratio"),
    )
