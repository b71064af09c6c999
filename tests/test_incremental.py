"""One changed month rewrites only its partitions, and the result is that of a full build."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from brisa.plans import incremental, warehouse
from brisa.sources import schemas

from . import domain_fixture as fx

TABLES = ["stg_movements", "movements_with_conditions", "traffic_baseline", "dim_asset", "hub_recovery", "hub_resilience", "route_risk", "carrier_performance"]


def write_flights(spark, path, rows):
    df = spark.createDataFrame(rows, schemas.FLIGHTS_RAW).withColumn("dt", F.trunc(F.substring("day", 1, 10).cast("date"), "month"))
    df.write.mode("append").partitionBy("dt").parquet(path)


def write_weather(spark, path, rows):
    df = spark.createDataFrame(rows, schemas.WEATHER_RAW).withColumn("obs_month", F.trunc("obs_date", "month"))
    df.write.mode("append").partitionBy("obs_month").parquet(path)


def partitions(out):
    """Files of each month partition."""
    found = {}
    for f in glob.glob(f"{out}/*/layout_month=*/*.parquet"):
        table, month = f.split("/")[-3:-1]
        found.setdefault((table, month.split("=")[1]), set()).add(os.path.basename(f))
    return found


def content(spark, out, table):
    df = spark.read.parquet(f"{out}/{table}")
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("incremental"))
    inp = fx.write(spark, f"{base}/in")
    for name in ("flights", "weather"):
        shutil.rmtree(f"{base}/in/{name}")
    write_flights(spark, inp.flights, fx.flights())
    write_weather(spark, inp.weather, fx.weather())
    assert incremental.build(spark, inp, f"{base}/out").kind == "full"
    return base, inp


def full(spark, base, inp, name):
    warehouse.run(spark, inp, f"{base}/{name}")
    return f"{base}/{name}"


def changed_partitions(before, after):
    return {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}


def test_changes_rewrite_their_own_partitions(spark, built):
    base, inp = built
    out = f"{base}/out"
    assert incremental.build(spark, inp, out).kind == "none"

    # A late file of a month outside the base year, with one repeated movement and one that replaces an earlier state.
    before = partitions(out)
    write_flights(spark, inp.flights, [
        fx.flight("BAW43", "EAAC", "LAAD", fx.ms(2020, 2, 3, 7, 0), fx.ms(2020, 2, 3, 8, 40)),
        fx.flight("NEW1", "EAAB", "EAAC", fx.ms(2020, 2, 29, 23, 30), fx.ms(2020, 3, 1, 0, 20)),
    ])
    report = incremental.build(spark, inp, out)
    feb = dt.date(2020, 2, 1)
    assert report.kind == "partial" and set(map(tuple, report.months.values())) == {(feb,)}
    assert {m for _, m in changed_partitions(before, partitions(out))} == {"2020-02-01"}

    # Observations of March 2019 (base year): its movements, and the March of every year in what compares with the base.
    before = partitions(out)
    write_weather(spark, inp.weather, [("EAAC", fx.ns(2019, 3, 10, 23), dt.date(2019, 3, 10), 1.0, 50.0, 2.0, 4.0, 180.0, 0.0, 0.0, 2.0, 0.0, 10.0, 1000.0, 0.0, 0.0)])
    report = incremental.build(spark, inp, out)
    march, march22 = dt.date(2019, 3, 1), dt.date(2022, 3, 1)
    assert report.months["movements_with_conditions"] == [march] and "stg_movements" not in report.months
    assert report.months["hub_recovery"] == [march, march22] == report.months["carrier_performance"]
    assert {m for _, m in changed_partitions(before, partitions(out))} == {"2019-03-01", "2022-03-01"}

    # A month's folder goes, another one comes.
    shutil.rmtree(f"{inp.flights}/dt=2019-05-01")
    write_flights(spark, inp.flights, [fx.flight("NEW2", "LAAD", "EAAC", fx.ms(2021, 5, 3, 9, 0), fx.ms(2021, 5, 3, 10, 0))])
    report = incremental.build(spark, inp, out)
    assert report.months["stg_movements"] == [dt.date(2019, 5, 1), dt.date(2021, 5, 1)]
    assert ("stg_movements", "2019-05-01") not in partitions(out)

    fresh = full(spark, base, inp, "fresh")
    for table in TABLES:
        assert content(spark, out, table) == content(spark, fresh, table), table
    from brisa.plans import serving

    for table, roll in (("resilience_sketches", serving.resilience_by_period), ("hub_day_bitmaps", serving.active_days_by_period)):
        now, then = (sorted(map(repr, roll(spark.read.parquet(f"{o}/{table}")).collect())) for o in (out, fresh))
        assert now == then


def test_a_build_that_was_cut_off_is_done_again(spark, built, monkeypatch):
    base, inp = built
    out = f"{base}/out"
    write_flights(spark, inp.flights, [fx.flight("NEW3", "LAAD", "EAAC", fx.ms(2021, 7, 3, 9, 0), fx.ms(2021, 7, 3, 10, 0))])
    with monkeypatch.context() as m:
        m.setattr(incremental.marts, "carrier_performance", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError):
            incremental.build(spark, inp, out)
    report = incremental.build(spark, inp, out)
    assert report.months["carrier_performance"] == [dt.date(2021, 7, 1)]
    assert spark.read.parquet(f"{out}/carrier_performance").filter("month = '2021-07-01'").count() == 1
    assert spark.read.parquet(f"{out}/stg_movements").filter("callsign = 'NEW3'").count() == 1


def test_both_deliveries_and_the_routes_come_from_one_pass(spark, monkeypatch):
    """The joined tables are read once; what the query hands to the build is all of them, less the late rows."""
    from brisa.plans import catalog_ops, tpch

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    seen, plans, plain = [], [], tpch.Model.raw_routes

    def routes(self, *a):
        out = plain(self, *a)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    def stop(spark, inp, *a):
        seen.append(inp)
        raise InterruptedError

    monkeypatch.setattr(tpch.Model, "raw_routes", routes)
    monkeypatch.setattr(catalog_ops.incremental, "build", stop)
    with pytest.raises(InterruptedError):
        catalog_ops.q_incremental_build(spark, sf)
    assert len(plans) == 1 and "l_orderkey" not in plans[0]
    m = tpch.Model(spark, sf)
    raw = m.raw_movements()
    late = raw.filter((F.col("registration") == "R") & F.substring("day", 1, 7).isin(f"{tpch.BASE_YEAR}-03", f"{tpch.BASE_YEAR + 2}-06"))
    assert late.count() > 0 and spark.read.parquet(seen[0].flights).count() == raw.count() - late.count()
    want = plain(m).select("airline", "source_airport", "destination_airport", "codeshare", F.col("stops").cast("string"), "equipment")
    got = spark.read.schema(schemas.ROUTES_RAW).csv(seen[0].routes).select("airline", "source_airport", "destination_airport", "codeshare", F.col("stops").cast("string"), "equipment")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
