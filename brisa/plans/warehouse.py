"""The full build on landed domain files: raw -> staging -> dimensions ->
conditions join -> marts -> serving queries -> data-quality summary.

Intermediate models read by several later models (staged movements, the
conditions join) are written as tables to ``out_dir`` and read back, which cuts
the lineage and lets the marts scan only the columns they need; marts are
written with the month layout of the warehouse (X2).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import WEATHER_RULES, Rule
from ..functions.scalars import normalize_nulls
from ..sources import files, schemas
from . import dims, domain_quality, marts, serving, staging

OBS_MEASURES = marts.WEATHER_MEASURES

# Country scope of the hub ranking (EU-27, United Kingdom,
# Switzerland, Norway; ISO alpha-2 codes as in the place list).
EUROPE_SCOPE = [
    "AT", "BE", "BG", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GR", "HR", "HU", "IE",
    "IT", "LT", "LU", "LV", "MT", "NL", "PL", "PT", "RO", "SE", "SI", "SK", "GB", "CH", "NO",
]


@dataclass
class Inputs:
    """Paths of the landed inputs (Parquet for the large logs, CSV for reference files)."""

    flights: str
    weather: str
    airports: str
    airlines: str
    routes: str
    hub_seed: str | None = None  # None: rank the hubs from the movements (M1)
    weather_format: str = "parquet"  # or "json" (API payload of parallel arrays)


@dataclass
class Build:
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, k: str) -> DataFrame:
        return self.tables[k]


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """Raw movement log; null tokens ('', 'nan', ...) in strings become nulls at load (N1, trap T2)."""
    flights = files.load_parquet(spark, path, schemas.FLIGHTS_RAW)
    strings = {f.name for f in schemas.FLIGHTS_RAW.fields if f.dataType.typeName() == "string"}
    return flights.select(*[normalize_nulls(c).alias(c) if c in strings else F.col(c) for c in flights.columns])


def build_hub_seed(
    spark: SparkSession,
    flights_path: str,
    airports_path: str,
    out_path: str | None = None,
    year: int = 2019,
    n: int = 20,
    countries: list[str] = EUROPE_SCOPE,
) -> DataFrame:
    """Rank stations by base-year movements within the country scope and write the seed.

    The ranking is one pass over the movement log with partial aggregation and
    a top-N; only the ``n`` ranked rows reach the single CSV writer task.
    """
    places = staging.stg_places(files.read_csv(spark, airports_path, schemas.AIRPORTS_RAW))
    ranked = marts.rank_hubs(read_flights(spark, flights_path), places, countries, year, n)
    seed = ranked.select(
        "station", F.col("station_iata").alias("iata"), F.col("place_name").alias("name"), "country", "latitude", "longitude"
    )
    if out_path is not None:
        files.write_small_csv(seed, out_path, max_rows=n)
        return files.read_seed(spark, out_path, schemas.HUB_SEED)
    return seed


def read_inputs(spark: SparkSession, inp: Inputs, calendar: marts.Calendar = marts.Calendar()) -> dict[str, DataFrame]:
    flights = read_flights(spark, inp.flights)
    if inp.weather_format == "json":
        payload = spark.read.schema(schemas.WEATHER_PAYLOAD).option("multiLine", True).json(inp.weather)
        # The payload does not name its station; the file does (four capitals standing alone).
        named = F.nullif(F.regexp_extract(F.col("_metadata.file_name"), "(?:^|[^A-Za-z])([A-Z]{4})(?:[^A-Za-z]|$)", 1), F.lit(""))
        payload = payload.withColumn("airport_icao", F.coalesce("airport_icao", named))
        weather = files.explode_parallel_arrays(payload, "hourly", keep=["airport_icao", "latitude", "longitude"])
        weather = weather.withColumn("obs_time", F.unix_micros(F.col("time").cast("timestamp")) * F.lit(1000))
    else:
        weather = files.load_parquet(spark, inp.weather, schemas.WEATHER_RAW)
    return {
        "flights": flights,
        "weather": weather,
        "airports": files.read_csv(spark, inp.airports, schemas.AIRPORTS_RAW),
        "airlines": files.read_csv_headerless(spark, inp.airlines, schemas.AIRLINES_RAW),
        "routes": files.read_csv_headerless(spark, inp.routes, schemas.ROUTES_RAW),
        "hubs": files.read_seed(spark, inp.hub_seed, schemas.HUB_SEED)
        if inp.hub_seed
        else build_hub_seed(spark, inp.flights, inp.airports, year=calendar.base_year),
    }


def run(
    spark: SparkSession,
    inp: Inputs,
    out_dir: str,
    calendar: marts.Calendar = marts.Calendar(),
    rules: list[Rule] = WEATHER_RULES,
    write_marts: bool = True,
) -> Build:
    """Build every model; returns the frames (tables read back from ``out_dir``)."""
    raw = read_inputs(spark, inp, calendar)
    out = Build()
    t = out.tables

    def table(name: str, df: DataFrame, month_of: str | None = None, cluster: tuple = ()) -> DataFrame:
        path = f"{out_dir.rstrip('/')}/{name}"
        files.write_layout(df, path, month_of, cluster, month_name="layout_month")
        back = spark.read.parquet(path)
        return back.drop("layout_month") if month_of else back

    hubs = raw["hubs"].select("station", "iata", F.col("name").alias("place_name"), "country")
    t["stg_movements"] = table("stg_movements", staging.stg_movements(raw["flights"]), "movement_date", ("origin", "destination"))
    t["stg_observations"] = staging.stg_observations(raw["weather"], schemas.WEATHER_MEASURE_FIELDS)
    t["stg_places"] = staging.stg_places(raw["airports"])
    t["stg_carriers"] = staging.stg_carriers(raw["airlines"])
    t["stg_routes"] = staging.stg_routes(raw["routes"])

    # Dimensions and the baseline are tables too: the quality checks read each of them several times.
    t["dim_place"] = table("dim_place", dims.dim_place(t["stg_places"], hubs))
    t["dim_carrier"] = table("dim_carrier", dims.dim_carrier(t["stg_carriers"]))
    t["dim_asset"] = table("dim_asset", dims.dim_asset(t["stg_movements"]))
    t["dim_date"] = table("dim_date", dims.dim_date(spark, f"{calendar.base_year}-01-01", f"{calendar.recovery_year + 1}-01-01"))
    t["dim_event"] = table("dim_event", dims.dim_event(spark))
    t["dim_phase"] = table("dim_phase", dims.dim_phase(spark, calendar.base_year))

    cond = marts.movements_with_conditions(t["stg_movements"], t["stg_observations"], hubs, OBS_MEASURES, rules, split_hot=True)
    t["movements_with_conditions"] = table("movements_with_conditions", cond, "movement_date", ("origin", "destination"))
    t["traffic_baseline"] = table("traffic_baseline", marts.traffic_baseline(t["stg_movements"], hubs, calendar.base_year))
    t["hub_recovery"] = marts.recovery(t["movements_with_conditions"], hubs, t["traffic_baseline"], t["dim_phase"])
    t["hub_resilience"] = marts.resilience_profile(t["movements_with_conditions"], hubs)
    t["resilience_sketches"] = marts.resilience_sketches(t["movements_with_conditions"], hubs)
    t["hub_day_bitmaps"] = marts.hub_day_bitmaps(t["movements_with_conditions"], hubs)
    t["route_risk"] = marts.route_risk(t["movements_with_conditions"], calendar)
    t["carrier_performance"] = marts.carrier_performance(t["movements_with_conditions"], hubs, calendar.base_year)
    if write_marts:
        t["hub_recovery"] = table("hub_recovery", t["hub_recovery"], "month", ("hub",))
        t["hub_resilience"] = table("hub_resilience", t["hub_resilience"], "month", ("hub", "event"))
        t["resilience_sketches"] = table("resilience_sketches", t["resilience_sketches"], "month", ("hub", "event"))
        t["hub_day_bitmaps"] = table("hub_day_bitmaps", t["hub_day_bitmaps"], "month", ("hub", "event"))
        t["route_risk"] = table("route_risk", t["route_risk"], None, ("origin", "destination"))
        t["carrier_performance"] = table("carrier_performance", t["carrier_performance"], "month", ("carrier",))

    t["cross_stress"] = serving.cross_stress(t["hub_recovery"], t["hub_resilience"], t["dim_place"], calendar.recovery_year)
    t["stress_correlation"] = serving.stress_correlation(t["cross_stress"])
    t["hub_condition_profile"] = serving.hub_condition_profile(t["hub_resilience"], t["dim_place"])
    t["resilience_by_year"] = serving.resilience_by_period(t["resilience_sketches"])
    t["active_days_by_year"] = serving.active_days_by_period(t["hub_day_bitmaps"])
    t["carrier_trajectory"] = serving.carrier_trajectory(t["carrier_performance"], t["dim_carrier"], 12)
    t["hub_series"] = serving.hub_series(t["hub_recovery"], t["dim_place"])
    t["top_routes"] = serving.top_routes(t["route_risk"], 200)
    t["recovery_ranking"] = serving.recovery_ranking(t["hub_series"], calendar.recovery_year)
    t["condition_mix"] = serving.condition_mix(t["hub_condition_profile"])
    t["most_sensitive"] = serving.most_sensitive(t["route_risk"], 15)
    t["score_table"] = serving.score_table(t["cross_stress"])
    t["quality"] = domain_quality.declared_checks(t, hubs)
    t["quality_summary"] = t["quality"].groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))
    return out
