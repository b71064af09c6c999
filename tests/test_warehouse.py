import datetime as dt

import pytest
from pyspark.sql import functions as F

from brisa.plans import warehouse

from . import domain_fixture as fx


@pytest.fixture(scope="module")
def build(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("domain"))
    inp = fx.write(spark, f"{base}/in")
    return warehouse.run(spark, inp, f"{base}/out")


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_staging_filters_and_dedup(build):
    stg = build["stg_movements"]
    assert stg.count() == 36
    baw1 = stg.filter(F.col("callsign") == "BAW1").collect()
    assert len(baw1) == 1 and baw1[0].duration_minutes == 90.0 and baw1[0].carrier == "BAW"
    dlh2 = stg.filter(F.col("callsign") == "DLH2").collect()
    assert len(dlh2) == 1 and dlh2[0].last_seen_at.minute == 30
    assert stg.filter(F.col("callsign").isin("XXX9", "AFR3", "AFR8")).count() == 0
    assert stg.filter(F.col("callsign").isNull()).count() == 1
    assert stg.select("movement_id").distinct().count() == 36


def test_staging_reference_files(build):
    carriers = {r.carrier: r for r in build["stg_carriers"].collect()}
    assert set(carriers) == {"BAW", "DLH", "UAL"} and len(build["stg_carriers"].collect()) == 4
    dim = {r.carrier: (r.carrier_id, r.carrier_name) for r in build["dim_carrier"].collect()}
    assert dim["BAW"] == (1, "British Airways") and dim["UAL"][1] == "Padded"
    ual = [r for r in build["stg_carriers"].collect() if r.carrier == "UAL"][0]
    assert ual.is_active is None and ual.carrier_alias is None
    routes = build["stg_routes"].collect()
    assert len(routes) == 2 and {r.is_codeshare for r in routes} == {False, True}
    places = {r.station: r.is_hub for r in build["dim_place"].collect()}
    assert places == {"EAAC": True, "EAAB": True, "LAAD": True, "KJFK": False, "KBOS": False}


def test_all_measures_are_staged(build):
    from brisa.sources import schemas

    assert set(schemas.WEATHER_MEASURE_FIELDS) <= set(build["stg_observations"].columns)


def test_conditions_join(build):
    cond = {r.callsign: r for r in build["movements_with_conditions"].collect() if r.callsign}
    assert "UAL7" not in cond  # neither end is a hub
    assert len(build["movements_with_conditions"].collect()) == 35
    assert (cond["BAW1"].origin_event, cond["BAW1"].destination_event) == ("snow", "clear")
    assert (cond["DLH2"].origin_event, cond["DLH2"].destination_event) == ("storm", None)
    assert (cond["BAW4"].origin_event, cond["BAW4"].destination_event) == (None, "fog")
    assert cond["BAW5"].destination_event is None
    assert cond["BAW1"].origin_snowfall == 0.25


def test_baseline_and_recovery(build):
    base = {(r.hub, r.month): (r.departures_base, r.arrivals_base, r.total_base) for r in build["traffic_baseline"].collect()}
    assert base[("EAAC", dt.date(2019, 1, 1))] == (13, 0, 13)
    assert base[("EAAC", dt.date(2019, 2, 1))] == (0, 11, 11)
    rec = {(r.hub, r.month): r for r in build["hub_recovery"].collect()}
    assert rec[("EAAC", dt.date(2019, 1, 1))].recovery_ratio == 1.0  # a base-year month against itself (T9)
    r22 = rec[("EAAC", dt.date(2022, 3, 1))]
    assert (r22.total_movements, r22.baseline_movements, r22.recovery_ratio, r22.phase) == (3, 2, 1.5, "recovery")
    assert rec[("EAAC", dt.date(2020, 2, 1))].phase == "collapse"
    assert rec[("EAAC", dt.date(2020, 2, 1))].movement_delta == 2 - 11  # against 11 February base-year arrivals


def test_resilience_profile(build):
    res = {(r.hub, r.month, r.event): r for r in build["hub_resilience"].collect()}
    jan = res[("EAAC", dt.date(2019, 1, 1), "snow")]
    assert jan.total_movements == 1 and jan.stddev_duration_minutes is None
    clear = res[("EAAC", dt.date(2019, 1, 1), "clear")]
    assert clear.total_movements == 12 and clear.p50_duration_minutes == 70.0


def test_route_risk(build):
    rr = {(r.origin, r.destination): r for r in build["route_risk"].collect()}
    assert ("EAAB", "EAAC") not in rr  # 11 base-year flights < 12
    a = rr[("EAAC", "LAAD")]
    assert a.total_flights_base == 14
    assert (a.clear_days_base, a.bad_days_base) == (13, 1)  # the mixed day counts on both sides (T7)
    assert a.avg_monthly_base == 7.0 and a.avg_monthly_collapse == 2.0 and a.shock_sensitivity_index == 0.7143


def test_shock_null_without_collapse_flights(spark, build):
    from brisa.plans import marts

    s = {(r.origin, r.destination): r for r in marts.shock_sensitivity(build["movements_with_conditions"]).collect()}
    assert s[("EAAB", "EAAC")].avg_monthly_collapse is None and s[("EAAB", "EAAC")].shock_sensitivity_index is None


def test_carrier_performance(build):
    perf = build["carrier_performance"].collect()
    assert {r.carrier for r in perf} == {"BAW", "DLH", "UAL"}
    assert all(r.hub_concentration_ratio == 1.0 for r in perf)  # conditions input is hub-touching (T10)
    jan = [r for r in perf if r.carrier == "BAW" and r.month == dt.date(2019, 1, 1)][0]
    assert jan.traffic_recovery_ratio == 1.0 and jan.clear_flights == 12


def test_serving_and_quality(build):
    scores = build["cross_stress"].collect()
    assert {r.hub for r in scores} <= set(fx.HUBS) and len(scores) >= 1
    assert build["stress_correlation"].count() == 1
    traj = build["carrier_trajectory"].collect()
    assert {r.carrier_name for r in traj} >= {"British Airways"}
    q = {(r.check_name, r.relation, r.column_name): r for r in build["quality"].collect()}
    assert q[("unique", "stg_movements", "movement_id")].status == "pass"
    assert q[("every_hub_has_baseline", "hubs", "station")].status == "pass"
    assert q[("no_end_before_start", "movements_with_conditions", "*")].failures == 0
    assert q[("unique", "dim_carrier", "carrier")].status == "pass"


def test_weather_json_payload_matches_parquet(spark, tmp_path_factory, build):
    # The API form (one object per station with parallel hourly arrays) gives the same events.
    import json

    base = str(tmp_path_factory.mktemp("json"))
    inp = fx.write(spark, f"{base}/in")
    by_station = {}
    for r in fx.weather():
        st, nanos = r[0], r[1]
        t = dt.datetime.fromtimestamp(nanos / 1e9, dt.UTC).strftime("%Y-%m-%dT%H:%M")
        h = by_station.setdefault(st, {"time": [], **{m: [] for m in fx.schemas.WEATHER_MEASURE_FIELDS}})
        h["time"].append(t)
        for i, m in enumerate(fx.schemas.WEATHER_MEASURE_FIELDS):
            h[m].append(r[3 + i])
    import os

    os.makedirs(f"{base}/weather_json")
    for st, h in by_station.items():  # one document per station, as the pull job writes them
        with open(f"{base}/weather_json/{st}.json", "w") as f:
            json.dump({"airport_icao": st, "latitude": 0.0, "longitude": 0.0, "hourly": h}, f, indent=1)
    inp.weather, inp.weather_format = f"{base}/weather_json", "json"
    j = warehouse.run(spark, inp, f"{base}/out", write_marts=False)
    ev = lambda b: sorted(rows(b["movements_with_conditions"], "movement_id", "origin_event", "destination_event"), key=str)
    assert ev(j) == ev(build)


def test_declared_quality_suite(build):
    q = {(r.check_name, r.relation, r.column_name): r for r in build["quality"].collect()}
    assert len(q) >= 100
    assert q[("unique", "stg_movements", "movement_id")].status == "pass"
    assert q[("not_null", "stg_movements", "callsign")].failures == 1  # the null call sign is kept and reported
    assert q[("accepted_values", "stg_places", "place_type")].status == "pass"
    assert q[("not_null", "stg_carriers", "is_active")].failures == 1  # padded row without a flag (T18)
    assert q[("not_null", "hub_recovery", "phase")].status == "pass"
    assert q[("row_count", "movements_with_conditions", "*")].status == "error"  # fixture is far below 10 M rows
    assert q[("relationships", "route_risk", "origin")].severity == "warn"
    assert q[("observation_within_day", "movements_with_conditions", "*")].failures == 0
    s = {r.status: r.n_checks for r in build["quality_summary"].collect()}
    assert sum(s.values()) == len(q)


def test_build_hub_seed_ranks_within_scope(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("seed"))
    inp = fx.write(spark, f"{base}/in")
    seed = warehouse.build_hub_seed(spark, inp.flights, inp.airports, f"{base}/seed", year=2019, n=3, countries=["GB", "DE", "FR"])
    got = [(r.station, r.iata, r.country) for r in seed.collect()]
    # ordered by raw 2019 movements (duplicates included, as in the ranking query); KJFK is out of scope
    assert got == [("EAAC", "NMF", "GB"), ("LAAD", "SBF", "FR"), ("EAAB", "ERF", "DE")]
    default_scope = warehouse.build_hub_seed(spark, inp.flights, inp.airports, n=20)
    assert {r.station for r in default_scope.collect()} == {"EAAC", "EAAB", "LAAD"}
