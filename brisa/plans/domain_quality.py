"""The declared data tests of the domain models (Q1-Q13).

Column-level checks of each relation (not-null, accepted values, value
ranges, mean, row count, row-condition tests) run in one aggregate pass per
relation; uniqueness and foreign keys are one grouping or anti-join each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.key_checks import ForeignKey, UniqueKey, key_checks
from ..sources.schemas import PLACE_TYPES

# Accepted condition and phase labels.
EVENT_LABELS = ["clear", "windy", "snow", "fog", "storm"]
PHASE_LABELS = ["pre_shock", "collapse", "restricted", "recovery"]

C, R = q.RelationChecks, q.RangeRule


def _present(c: str):
    return F.col(c).isNotNull()


def column_checks() -> dict[str, dict]:
    """The declared column tests (columns, bounds, accepted values).

    Built on call because row conditions are Spark columns.
    """
    return {
        "stg_movements": dict(not_null=["movement_id", "callsign", "movement_date", "first_seen_at", "last_seen_at", "duration_minutes"]),
        "stg_carriers": dict(not_null=["carrier_id", "carrier", "carrier_name", "is_active"]),
        "stg_routes": dict(not_null=["origin", "destination", "is_codeshare"]),
        "stg_observations": dict(not_null=["observation_id", "station", "observed_at", "observation_date", "observation_hour"]),
        "stg_places": dict(not_null=["station", "place_name", "latitude", "longitude", "country"], accepted={"place_type": PLACE_TYPES}),
        "movements_with_conditions": dict(
            row_count_between=(10_000_000, 16_000_000),
            not_null=["movement_id", "movement_date"],
            ranges=[R("duration_minutes", 0, 3000)],
            mean_between={"duration_minutes": (60, 300)},
            accepted={"origin_event": EVENT_LABELS, "destination_event": EVENT_LABELS},
        ),
        "traffic_baseline": dict(
            row_count_between=(200, 300), not_null=["hub", "month", "departures_base", "arrivals_base", "total_base"]
        ),
        "dim_asset": dict(not_null=["asset_id"]),
        "dim_carrier": dict(not_null=["carrier", "carrier_name", "is_active"]),
        "dim_place": dict(not_null=["station", "place_name", "latitude", "longitude", "country", "is_hub"]),
        "dim_date": dict(not_null=["date_day", "year", "quarter_of_year", "month", "is_weekend"]),
        "dim_phase": dict(not_null=["phase", "phase_start_date", "phase_end_date", "description"], accepted={"phase": PHASE_LABELS}),
        "dim_event": dict(not_null=["event", "description"], accepted={"event": EVENT_LABELS}),
        "carrier_performance": dict(
            row_count_between=(45_000, 65_000),
            not_null=["carrier", "month", "total_flights"],
            ranges=[
                R("total_flights", 1, 10_000_000),
                R("hub_concentration_ratio", 0, 1, row_condition=_present("hub_concentration_ratio")),
                R("traffic_recovery_ratio", 0, 3000, row_condition=_present("traffic_recovery_ratio")),
            ],
        ),
        "hub_recovery": dict(
            row_count_between=(800, 1100),
            not_null=["hub", "month", "total_movements", "phase"],
            ranges=[R("total_movements", 1, 10_000_000), R("recovery_ratio", 0, 10, row_condition=_present("recovery_ratio"))],
            accepted={"phase": PHASE_LABELS},
        ),
        "hub_resilience": dict(
            row_count_between=(2500, 4000),
            not_null=["hub", "month", "event", "total_movements"],
            accepted={"event": EVENT_LABELS},
            ranges=[
                R("total_movements", 1, 10_000_000),
                R("avg_duration_minutes", 0, 3000, row_condition=_present("avg_duration_minutes")),
            ],
        ),
        "route_risk": dict(
            row_count_between=(7000, 12_000),
            not_null=["origin", "destination", "total_flights_base"],
            ranges=[
                R("total_flights_base", 12, 10_000_000),
                R("weather_sensitivity_index", -100, 1, row_condition=_present("weather_sensitivity_index")),
            ],
        ),
    }


# Declared unique keys and foreign keys (child, column, parent, column, severity).
UNIQUE_KEYS = [
    ("stg_movements", ["movement_id"]),
    ("stg_carriers", ["carrier_id"]),
    ("stg_observations", ["observation_id"]),
    ("stg_places", ["station"]),
    ("movements_with_conditions", ["movement_id"]),
    ("traffic_baseline", ["hub", "month"]),
    ("dim_asset", ["asset_id"]),
    ("dim_carrier", ["carrier"]),
    ("dim_place", ["station"]),
    ("dim_date", ["date_day"]),
    ("dim_phase", ["phase"]),
    ("dim_event", ["event"]),
    ("carrier_performance", ["carrier", "month"]),
    ("hub_recovery", ["hub", "month"]),
    ("hub_resilience", ["hub", "month", "event"]),
    ("route_risk", ["origin", "destination"]),
]

FOREIGN_KEYS = [
    ("traffic_baseline", "hub", "dim_place", "station", "error"),
    ("traffic_baseline", "month", "dim_date", "date_day", "error"),
    ("carrier_performance", "carrier", "dim_carrier", "carrier", "warn"),
    ("carrier_performance", "month", "dim_date", "date_day", "error"),
    ("hub_recovery", "hub", "dim_place", "station", "error"),
    ("hub_recovery", "month", "dim_date", "date_day", "error"),
    ("hub_recovery", "phase", "dim_phase", "phase", "error"),
    ("hub_resilience", "hub", "dim_place", "station", "error"),
    ("hub_resilience", "month", "dim_date", "date_day", "error"),
    ("hub_resilience", "event", "dim_event", "event", "error"),
    ("route_risk", "origin", "dim_place", "station", "warn"),
    ("route_risk", "destination", "dim_place", "station", "warn"),
]


def declared_checks(t: dict[str, DataFrame], hubs: DataFrame) -> DataFrame:
    """Every declared test as one row ``(check_name, relation, column_name, severity, failures, status)``."""
    rows: list[DataFrame] = []
    for rel, spec in column_checks().items():
        spec = dict(spec)
        if rel == "movements_with_conditions":
            spec["singular"] = {
                "no_end_before_start": F.col("last_seen_at") < F.col("first_seen_at"),
                "observation_within_day": q.outside_day(
                    "movement_date", [("origin_event", "first_seen_at"), ("destination_event", "last_seen_at")]
                ),
            }
        rows.append(q.relation_checks(t[rel], C(rel, **spec)))
    keys: list = [UniqueKey(rel, t[rel], cols) for rel, cols in UNIQUE_KEYS]
    keys += [ForeignKey(rel, t[rel], col, t[parent], pcol, severity=sev) for rel, col, parent, pcol, sev in FOREIGN_KEYS]
    keys.append(ForeignKey("hubs", hubs, "station", t["traffic_baseline"], "hub", check="every_hub_has_baseline"))
    rows.append(key_checks(keys))
    return q.union_checks(rows)
