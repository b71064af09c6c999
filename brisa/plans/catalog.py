"""Registry of named queries over the test tables, each with its SQL oracle.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, sql or None)``. Every query
reads the given tables (or frames Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.classify import classify, prefixed
from ..operators.joins import anti_join, hot_buckets, interval_join, semi_join, time_bucket_join, touches_any, with_membership_flag
from ..session import scratch_path
from ..sources.files import write_layout
from . import dims, marts, serving
from .oracle_sql import rules_case
from .oracle_sql import B, rnd, sdiv, sql
from .tpch import CALENDAR, OBS_MEASURES, RULES, Model, table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, oracle)
        return fn

    return deco


def ntz(df: DataFrame) -> DataFrame:
    """Return timestamps as ``timestamp_ntz`` (wall clock in UTC) for comparison."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def M(spark: SparkSession, d: str) -> Model:
    return Model(spark, d)


# --- flagship and marts ------------------------------------------------------


@register("recovery_by_hub", sql("SELECT * FROM recovery"))
def recovery_by_hub(spark, d):
    """M3 (U2, A1, M2, J4, J6, F19): monthly hub movements vs base-year month, with phase."""
    return M(spark, d).recovery()


@register("traffic_baseline", sql("SELECT * FROM baseline"))
def traffic_baseline(spark, d):
    """M2 in one pass over the movements."""
    return M(spark, d).baseline()


@register(
    "baseline_full_outer",
    sql(
        f"""SELECT hub, month, count(*) FILTER (WHERE side = 'from') AS departures_base,
       count(*) FILTER (WHERE side = 'to') AS arrivals_base, count(*) AS total_base
FROM (SELECT unnest([origin, destination]) AS hub, unnest(['from', 'to']) AS side,
             make_date({B}, month(movement_date)::INT, 1) AS month
      FROM stg_movements WHERE date_part('year', movement_date) = {B}) ends
SEMI JOIN hubs ON hubs.station = ends.hub GROUP BY ALL"""
    ),
)
def baseline_full_outer(spark, d):
    """J7 + P7 + A1: the two-count shape of M2."""
    m = M(spark, d)
    return marts.baseline_by_full_outer(m.stg_movements(), m.hubs(), B)


@register("hub_ranking", sql("SELECT * FROM hubs"))
def hub_ranking(spark, d):
    """M1 (U3, P9, P10, O2): top stations by base-year movements in the region scope."""
    return M(spark, d).hubs()


@register(
    "touches_hub",
    sql("SELECT movement_id, origin, destination, movement_date FROM facts"),
)
def touches_hub(spark, d):
    """Movements with either end at a hub."""
    m = M(spark, d)
    return touches_any(
        m.stg_movements().select("movement_id", "origin", "destination", "movement_date"),
        ["origin", "destination"],
        m.hubs(),
        "station",
    )


@register(
    "hub_semi",
    sql("SELECT movement_id, origin FROM stg_movements WHERE origin IN (SELECT station FROM hubs)"),
)
def hub_semi(spark, d):
    """Movements departing from a hub."""
    m = M(spark, d)
    return semi_join(m.stg_movements().select("movement_id", "origin"), "origin", m.hubs(), "station")


@register(
    "hub_flag",
    sql(
        """SELECT movement_id, origin IN (SELECT station FROM hubs) AS origin_is_hub,
       destination IN (SELECT station FROM hubs) AS destination_is_hub FROM stg_movements"""
    ),
)
def hub_flag(spark, d):
    """Membership flags from a broadcast left join."""
    m = M(spark, d)
    f = with_membership_flag(m.stg_movements().select("movement_id", "origin", "destination"), "origin", m.hubs(), "station", "origin_is_hub")
    f = with_membership_flag(f, "destination", m.hubs(), "station", "destination_is_hub")
    return f.select("movement_id", "origin_is_hub", "destination_is_hub")


@register(
    "missing_baseline_anti",
    sql(
        """SELECT p.station, p.place_name FROM places p
WHERE NOT EXISTS (SELECT 1 FROM baseline b WHERE b.hub = p.station)"""
    ),
)
def missing_baseline_anti(spark, d):
    """Places with no base-year baseline row."""
    m = M(spark, d)
    return anti_join(m.places().select("station", "place_name"), "station", m.baseline(), "hub")


@register(
    "hour_bucket_join",
    sql(
        """SELECT s.movement_id, s.origin, g.price AS origin_price, g.balance AS origin_balance, g.priority AS origin_priority,
       CASE WHEN g.balance < 0 THEN 'snow' WHEN g.price > 400000 AND g.priority < 2 THEN 'storm'
            WHEN g.price > 350000 OR g.priority < 1.5 THEN 'windy' WHEN g.balance > 8000 AND g.priority > 4 THEN 'fog'
            WHEN g.station IS NOT NULL THEN 'clear' END AS origin_event
FROM stg_movements s
LEFT JOIN grid g ON s.origin = g.station AND date_trunc('hour', s.first_seen_at) = g.observation_hour"""
    ),
)
def hour_bucket_join(spark, d):
    """J5 + A14 + P14 + F11 at one end, over all staged movements."""
    m = M(spark, d)
    grid = m.grid()
    j = time_bucket_join(m.stg_movements().select("movement_id", "origin", "first_seen_at"), grid, "origin", "first_seen_at", OBS_MEASURES, "origin_")
    j = j.withColumn("origin_event", classify(RULES, F.col("origin_matched"), prefixed("origin_")))
    return j.select("movement_id", "origin", "origin_price", "origin_balance", "origin_priority", "origin_event")


@register(
    "two_end_bucket_join",
    sql(
        f"""SELECT s.movement_id, go.price AS origin_price, {rules_case("go")} AS origin_event,
       gd.price AS destination_price, {rules_case("gd")} AS destination_event
FROM stg_movements s
LEFT JOIN grid go ON s.origin = go.station AND date_trunc('hour', s.first_seen_at) = go.observation_hour
LEFT JOIN grid gd ON s.destination = gd.station AND date_trunc('hour', s.last_seen_at) = gd.observation_hour"""
    ),
)
def two_end_bucket_join(spark, d):
    """J5 at both ends with two timestamps, over all staged movements (no hub filter)."""
    m = M(spark, d)
    grid = m.grid()
    f = m.stg_movements().select("movement_id", "origin", "destination", "first_seen_at", "last_seen_at")
    j = time_bucket_join(f, grid, "origin", "first_seen_at", OBS_MEASURES, "origin_")
    j = time_bucket_join(j, grid, "destination", "last_seen_at", OBS_MEASURES, "destination_")
    return j.select(
        "movement_id",
        "origin_price",
        classify(RULES, F.col("origin_matched"), prefixed("origin_")).alias("origin_event"),
        "destination_price",
        classify(RULES, F.col("destination_matched"), prefixed("destination_")).alias("destination_event"),
    )


@register(
    "null_station_bucket_join",
    sql(
        """SELECT s.movement_id, g.price AS origin_price, g.station IS NOT NULL AS origin_matched
FROM stg_movements s
LEFT JOIN grid g ON CASE WHEN s.asset_type = 'F' THEN NULL ELSE s.origin END = g.station
  AND date_trunc('hour', s.first_seen_at) = g.observation_hour"""
    ),
)
def null_station_bucket_join(spark, d):
    """J5 where about half of the facts have no station, both sides shuffled and sorted."""
    m = M(spark, d)
    grid = marts.observation_grid(m.stg_observations(), OBS_MEASURES).hint("merge")
    f = m.stg_movements().select(
        "movement_id", F.when(F.col("asset_type") != "F", F.col("origin")).alias("station"), "first_seen_at"
    )
    j = time_bucket_join(f, grid, "station", "first_seen_at", OBS_MEASURES, "origin_")
    return j.select("movement_id", "origin_price", "origin_matched")


@register(
    "hot_bucket_join",
    sql(
        f"""SELECT f.movement_id, f.origin, go.price AS origin_price, {rules_case("go")} AS origin_event,
       gd.price AS destination_price, gd.station IS NOT NULL AS destination_matched
FROM (
  SELECT s.movement_id,
         CASE WHEN s.asset_type = 'F' THEN pair.station ELSE s.origin END AS origin,
         CASE WHEN s.asset_type = 'F' THEN pair.observation_hour + INTERVAL 5 MINUTE ELSE s.first_seen_at END AS first_seen_at,
         CASE WHEN s.asset_type = 'F' THEN pair.station ELSE s.destination END AS destination,
         CASE WHEN s.asset_type = 'F' THEN pair.observation_hour + INTERVAL 50 MINUTE ELSE s.last_seen_at END AS last_seen_at
  FROM stg_movements s, (SELECT station, observation_hour FROM grid ORDER BY observation_hour, station LIMIT 1) pair
) f
LEFT JOIN grid go ON f.origin = go.station AND date_trunc('hour', f.first_seen_at) = go.observation_hour
LEFT JOIN grid gd ON f.destination = gd.station AND date_trunc('hour', f.last_seen_at) = gd.observation_hour"""
    ),
)
def hot_bucket_join(spark, d):
    """J5 at both ends where one (station, hour) pair holds about half of the movements: hot pairs are found and split, nothing is broadcast."""
    m = M(spark, d)
    grid = marts.observation_grid(m.stg_observations(), OBS_MEASURES)
    pair = grid.orderBy("observation_hour", "station").limit(1).select(F.col("station").alias("hot_station"), F.col("observation_hour").alias("hot_hour"))
    stg = m.stg_movements().select("movement_id", "asset_type", "origin", "destination", "first_seen_at", "last_seen_at")
    chosen = F.col("asset_type") == "F"
    facts = stg.join(F.broadcast(pair)).select(
        "movement_id",
        F.when(chosen, F.col("hot_station")).otherwise(F.col("origin")).alias("origin"),
        F.when(chosen, F.col("hot_hour") + F.expr("INTERVAL 5 MINUTE")).otherwise(F.col("first_seen_at")).alias("first_seen_at"),
        F.when(chosen, F.col("hot_station")).otherwise(F.col("destination")).alias("destination"),
        F.when(chosen, F.col("hot_hour") + F.expr("INTERVAL 50 MINUTE")).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
    )
    grid = grid.hint("merge")
    hot = [hot_buckets(facts, "origin", "first_seen_at"), hot_buckets(facts, "destination", "last_seen_at")]
    j = time_bucket_join(facts, grid, "origin", "first_seen_at", OBS_MEASURES, "origin_", hot=hot[0])
    j = j.withColumn("origin_event", classify(RULES, F.col("origin_matched"), prefixed("origin_")))
    j = time_bucket_join(j, grid, "destination", "last_seen_at", OBS_MEASURES, "destination_", hot=hot[1])
    return j.select("movement_id", "origin", "origin_price", "origin_event", "destination_price", "destination_matched")


@register(
    "interval_join",
    """SELECT p.p_partkey, count(*) AS orders, count(DISTINCT CAST(o.o_orderdate AS DATE)) AS days, min(o.o_orderkey) AS first_order
FROM part p JOIN orders o ON CAST(o.o_orderdate AS DATE)
  BETWEEN CAST(DATE '1995-01-01' + CAST((p.p_partkey * 37) % 2000 AS INTEGER) AS DATE)
  AND CAST(DATE '1995-01-01' + CAST((p.p_partkey * 37) % 2000 AS INTEGER) + CASE WHEN p.p_partkey % 50 = 0 THEN 700 ELSE p.p_size % 20 END AS DATE)
GROUP BY 1""",
)
def interval_join_query(spark, d):
    """Every order with every part whose sales window (short for most, two years for some) holds its date, counted per part; the orders are summed up per day first."""
    windows = table(spark, d, "part").select(
        "p_partkey",
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") * 37 % 2000).cast("int")).alias("starts"),
        F.when(F.col("p_partkey") % 50 == 0, F.lit(700)).otherwise(F.col("p_size") % 20).cast("int").alias("length"),
    )
    windows = windows.select("p_partkey", "starts", F.date_add("starts", F.col("length")).alias("ends"))
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    # Everything asked of a window's orders adds up from its days, so the days meet the windows: a pair per part and day, not per part and order.
    by_day = orders.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"))
    pairs = interval_join(by_day, windows, "day", "starts", "ends")
    return pairs.groupBy("p_partkey").agg(F.sum("n").alias("orders"), F.countDistinct("day").alias("days"), F.min("first").alias("first_order"))


@register(
    "keyed_interval_join",
    """SELECT a.o_orderkey, count(b.o_orderkey) AS earlier, min(b.o_orderkey) AS first_earlier
FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey
  AND a.o_orderdate BETWEEN b.o_orderdate + INTERVAL 1 MICROSECOND AND b.o_orderdate + INTERVAL 60 DAY
GROUP BY 1""",
)
def keyed_interval_join(spark, d):
    """J6 with an equal column and points that match nothing: a customer's orders in the 60 days before each order."""
    o = table(spark, d, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    after = o.select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("earlier_key"),
        (F.col("at") + F.expr("INTERVAL 0.000001 SECOND")).alias("starts"),
        (F.col("at") + F.expr("INTERVAL 60 DAY")).alias("ends"),
    )
    j = interval_join(o, after, "at", "starts", "ends", on=[("o_custkey", "customer")], how="left")
    return j.groupBy("o_orderkey").agg(F.count("earlier_key").alias("earlier"), F.min("earlier_key").alias("first_earlier"))


@register("movements_with_conditions", sql("SELECT * FROM cond"))
def movements_with_conditions(spark, d):
    """C6 (J9, A14, J5 x2, P14 x2): hub-touching movements with conditions at both ends."""
    return ntz(M(spark, d).conditions())


@register("resilience_profile", sql("SELECT * FROM resilience"))
def resilience_profile(spark, d):
    """M4 (U2, F7, A1, A3, A4, A5, F23)."""
    return M(spark, d).resilience()


def _stored(df, name):
    """Written by month and read back, as the full build does."""
    path = scratch_path(df.sparkSession, name)
    write_layout(df, path, "month", ("hub", "event"), month_name="layout_month")
    return df.sparkSession.read.parquet(path).drop("layout_month")


@register(
    "resilience_by_year",
    sql(
        f"""SELECT hub, CAST(date_trunc('year', movement_date) AS DATE) AS period, coalesce(event, 'clear') AS event,
       count(duration_minutes) AS total_movements, {rnd("avg(duration_minutes)", 2)} AS avg_duration_minutes,
       {rnd("quantile_disc(duration_minutes, 0.5)", 2)} AS p50_duration_minutes,
       {rnd("quantile_disc(duration_minutes, 0.95)", 2)} AS p95_duration_minutes
FROM res_ends GROUP BY 1, 2, 3"""
    ),
)
def resilience_by_year(spark, d):
    """A5 + M4 -> M11: yearly duration quantiles merged from stored monthly sketches (exact up to 2,048 movements a group)."""
    m = M(spark, d)
    return serving.resilience_by_period(_stored(marts.resilience_sketches(m.conditions(), m.hubs()), "resilience_sketches"))


@register(
    "active_days_by_year",
    sql(
        """SELECT hub, CAST(date_trunc('year', movement_date) AS DATE) AS period, coalesce(event, 'clear') AS event,
       count(DISTINCT movement_date) AS active_days FROM res_ends WHERE movement_date IS NOT NULL GROUP BY 1, 2, 3"""
    ),
)
def active_days_by_year(spark, d):
    """Exact distinct days per year, OR-ed from stored monthly bitmaps."""
    m = M(spark, d)
    return serving.active_days_by_period(_stored(marts.hub_day_bitmaps(m.conditions(), m.hubs()), "hub_day_bitmaps"))


@register(
    "condition_sensitivity",
    sql(
        f"""SELECT origin, destination, total_flights_base, avg_flights_clear, avg_flights_bad, clear_days_base, bad_days_base,
       {rnd(sdiv("avg_flights_clear - avg_flights_bad", "avg_flights_clear"), 4)} AS weather_sensitivity_index
FROM weather_agg WHERE total_flights_base >= 12"""
    ),
)
def condition_sensitivity(spark, d):
    """M5 (A12, A7, A9, F19, P11)."""
    return marts.condition_sensitivity(M(spark, d).conditions(), CALENDAR)


@register(
    "shock_sensitivity",
    sql(
        f"""SELECT origin, destination, avg_monthly_base, avg_monthly_collapse,
       {rnd(sdiv("avg_monthly_base - avg_monthly_collapse", "avg_monthly_base"), 4)} AS shock_sensitivity_index
FROM shock_agg"""
    ),
)
def shock_sensitivity(spark, d):
    """M6 (A12, A7, F19)."""
    return marts.shock_sensitivity(M(spark, d).conditions(), CALENDAR)


@register("route_risk", sql("SELECT * FROM route_risk"))
def route_risk(spark, d):
    """M7 = M5 joined with M6."""
    return M(spark, d).route_risk()


@register("carrier_performance", sql("SELECT * FROM carrier_performance"))
def carrier_performance(spark, d):
    """M8 (A3-A10, J4, J10)."""
    return M(spark, d).carrier_performance()


@register(
    "carrier_trajectory",
    sql(
        """SELECT p.carrier, coalesce(dc.carrier_name, p.carrier) AS carrier_name, p.month, p.year, p.total_flights,
       p.traffic_recovery_ratio
FROM carrier_performance p
JOIN (SELECT carrier, sum(total_flights) AS lifetime FROM carrier_performance GROUP BY carrier
      ORDER BY lifetime DESC, carrier ASC LIMIT 12) r ON r.carrier = p.carrier
LEFT JOIN dim_carrier dc ON dc.carrier = p.carrier"""
    ),
)
def carrier_trajectory(spark, d):
    """M12 (J12, J3, F7)."""
    m = M(spark, d)
    return serving.carrier_trajectory(m.carrier_performance(), m.dim_carrier(), 12)


@register("cross_stress", sql("SELECT * FROM cross_stress"))
def cross_stress(spark, d):
    """M9 (A7, A11, J2, F19)."""
    return M(spark, d).cross_stress()


@register(
    "stress_correlation",
    sql(f"SELECT {rnd('corr(weather_resilience, shock_resilience)', 2)} AS r FROM cross_stress"),
)
def stress_correlation(spark, d):
    """M10 (A13, A15, F18)."""
    return serving.stress_correlation(M(spark, d).cross_stress())


@register("hub_condition_profile", sql("SELECT * FROM hub_condition_profile"))
def hub_condition_profile(spark, d):
    """M11 (A2, A11, J1)."""
    m = M(spark, d)
    return serving.hub_condition_profile(m.resilience(), m.dim_place())


@register(
    "condition_mix",
    sql("SELECT event, CAST(sum(total_movements) AS BIGINT) AS movements FROM hub_condition_profile GROUP BY event"),
)
def condition_mix(spark, d):
    """M16."""
    m = M(spark, d)
    return serving.condition_mix(serving.hub_condition_profile(m.resilience(), m.dim_place()))


@register(
    "recovery_ranking",
    sql(
        f"""SELECT place_name, {rnd("avg(recovery_ratio)", 3)} AS recovery_avg FROM hub_series
WHERE year = {CALENDAR.recovery_year} GROUP BY place_name"""
    ),
)
def recovery_ranking(spark, d):
    """M15."""
    m = M(spark, d)
    return serving.recovery_ranking(serving.hub_series(m.recovery(), m.dim_place()), CALENDAR.recovery_year)


@register("hub_series", sql("SELECT * FROM hub_series"))
def hub_series(spark, d):
    """M13 (J1, O1)."""
    m = M(spark, d)
    return serving.hub_series(m.recovery(), m.dim_place())


@register(
    "top_routes",
    sql(
        """SELECT origin, destination, CAST(origin AS VARCHAR) || ' -> ' || CAST(destination AS VARCHAR) AS route,
       total_flights_base, weather_sensitivity_index, shock_sensitivity_index
FROM route_risk WHERE weather_sensitivity_index IS NOT NULL AND shock_sensitivity_index IS NOT NULL
ORDER BY total_flights_base DESC, origin, destination LIMIT 200"""
    ),
)
def top_routes(spark, d):
    """M14 (P15, F4, O2)."""
    return serving.top_routes(M(spark, d).route_risk(), 200)


@register(
    "most_sensitive",
    sql(
        """SELECT CAST(origin AS VARCHAR) || ' -> ' || CAST(destination AS VARCHAR) AS route, total_flights_base,
       weather_sensitivity_index
FROM route_risk ORDER BY weather_sensitivity_index DESC NULLS LAST, route LIMIT 15"""
    ),
)
def most_sensitive(spark, d):
    """M17 (O2)."""
    return serving.most_sensitive(M(spark, d).route_risk(), 15)


@register(
    "score_table",
    sql("SELECT place_name, country, weather_resilience, shock_resilience FROM cross_stress"),
)
def score_table(spark, d):
    """M18 (P1, O1)."""
    return serving.score_table(M(spark, d).cross_stress())


# --- dimensions and staging -------------------------------------------------


@register("dim_place", sql("SELECT * FROM dim_place"))
def dim_place(spark, d):
    """C7 (P13)."""
    return M(spark, d).dim_place()


@register("dim_carrier", sql("SELECT * FROM dim_carrier"))
def dim_carrier(spark, d):
    """C8 (W2)."""
    return M(spark, d).dim_carrier()


@register(
    "dim_asset",
    sql(
        """SELECT asset_id, asset_registration, asset_type FROM (
  SELECT asset_id, asset_registration, asset_type,
         row_number() OVER (PARTITION BY asset_id ORDER BY n DESC, asset_registration NULLS FIRST, asset_type NULLS FIRST) AS rn
  FROM (SELECT asset_id, asset_registration, asset_type, count(*) AS n FROM stg_movements
        WHERE asset_id IS NOT NULL GROUP BY 1, 2, 3) c) t WHERE rn = 1"""
    ),
)
def dim_asset(spark, d):
    """C9 (W3)."""
    return dims.dim_asset(M(spark, d).stg_movements())


@register(
    "date_dimension",
    sql(
        """SELECT CAST(d AS DATE) AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter_of_year,
       CAST(month(d) AS INTEGER) AS month, CAST(strftime(d, '%U') AS INTEGER) AS week_of_year,
       CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
       monthname(d) AS month_name, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
       CAST(date_trunc('month', d) AS DATE) AS month_start_date, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date
FROM (SELECT unnest(generate_series(min(movement_date), max(movement_date), INTERVAL 1 DAY)) AS d FROM stg_movements) s"""
    ),
)
def date_dimension(spark, d):
    """C10 (S15, F12-F16, P12): calendar over the span of the staged movements."""
    from ..sources.lookups import date_spine_between

    bounds = M(spark, d).stg_movements().agg(F.min("movement_date").alias("lo"), F.max("movement_date").alias("hi"))
    return dims.calendar_attributes(date_spine_between(bounds, "lo", "hi"))


@register(
    "phase_lookup",
    sql(
        """SELECT p.phase, p.sort_order, count(*) AS movements
FROM stg_movements s LEFT JOIN phases p ON s.movement_date BETWEEN p.phase_start_date AND p.phase_end_date
GROUP BY 1, 2"""
    ),
)
def phase_lookup(spark, d):
    """C12 + J6 + S14: movements per phase (null outside every phase)."""
    from ..operators.joins import range_lookup

    m = M(spark, d)
    days = m.stg_movements().groupBy("movement_date").agg(F.count(F.lit(1)).alias("n"))
    j = range_lookup(days, "movement_date", m.phases(), "phase_start_date", "phase_end_date")
    return j.groupBy("phase", "sort_order").agg(F.sum("n").alias("movements"))


@register(
    "event_lookup",
    sql(
        """SELECT e.event, e.description, e.sort_order, coalesce(c.n, 0) AS origin_movements
FROM (VALUES ('clear', 'Minimal precipitation and low wind', 1),
             ('windy', 'Wind speed > 10 m/s or gusts > 15 m/s', 2),
             ('snow', 'Snowfall > 0 cm', 3),
             ('fog', 'Relative humidity > 90% and cloud cover > 80% (visibility proxy)', 4),
             ('storm', 'Wind gusts > 20 m/s and surface pressure < 990 hPa', 5)) e(event, description, sort_order)
LEFT JOIN (SELECT origin_event AS event, count(*) AS n FROM cond GROUP BY 1) c ON c.event = e.event"""
    ),
)
def event_lookup(spark, d):
    """C11 + U1 + S14: condition categories with their origin-end movement counts."""
    m = M(spark, d)
    counts = m.conditions().groupBy(F.col("origin_event").alias("__e")).agg(F.count(F.lit(1)).alias("__n"))
    ev = dims.dim_event(spark)
    j = ev.join(counts, ev["event"] == counts["__e"], "left")
    return j.select("event", "description", "sort_order", F.coalesce(F.col("__n"), F.lit(0)).alias("origin_movements"))


@register("stg_movements", sql("SELECT * FROM stg_movements"))
def stg_movements(spark, d):
    """C1 (F3, F5, F8, F9, F20, P3-P6, W1)."""
    return ntz(M(spark, d).stg_movements())


@register("stg_observations", sql("SELECT * FROM stg_obs"))
def stg_observations(spark, d):
    """C2 (F5, F10, F11)."""
    return ntz(M(spark, d).stg_observations())


@register("stg_places", sql("SELECT * FROM places"))
def stg_places(spark, d):
    """Places from the nation and region tables."""
    return M(spark, d).places()


@register("stg_carriers", sql("SELECT * FROM stg_carriers"))
def stg_carriers(spark, d):
    """C4 (F1, F2, F6, F22)."""
    return M(spark, d).stg_carriers()


@register(
    "stg_routes",
    sql(
        """SELECT nullif(trim(substr(callsign, 1, 3)), '\\N') AS carrier_code, CAST(NULL AS VARCHAR) AS carrier_id,
       nullif(trim(CAST(origin AS VARCHAR)), '\\N') AS origin, nullif(trim(CAST(origin AS VARCHAR)), '\\N') AS origin_id,
       nullif(trim(CAST(destination AS VARCHAR)), '\\N') AS destination,
       nullif(trim(CAST(destination AS VARCHAR)), '\\N') AS destination_id,
       coalesce(trim(CASE WHEN registration = 'R' THEN 'Y' END) = 'Y', false) AS is_codeshare,
       CAST(CAST(number AS BIGINT) - 1 AS BIGINT) AS stops, nullif(trim(typecode), '\\N') AS equipment
FROM raw_movements
WHERE nullif(trim(CAST(origin AS VARCHAR)), '\\N') IS NOT NULL AND nullif(trim(CAST(destination AS VARCHAR)), '\\N') IS NOT NULL"""
    ),
)
def stg_routes(spark, d):
    """C5 (F1, F2, F6, F22)."""
    return M(spark, d).stg_routes()


# Operator-level, scalar, quality and file-job queries register themselves on import.
from . import catalog_ops  # noqa: E402,F401
