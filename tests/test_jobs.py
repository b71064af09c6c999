import gzip
import os

import pytest

from brisa.__main__ import main
from brisa.sources import jobs, schemas

from . import domain_fixture as fx

HEADER = ",".join(schemas.FLIGHTS_RAW.fieldNames())


def _csv(path, rows):
    with gzip.open(path, "wt") as f:
        f.write(HEADER + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_land_flight_files_resume_and_overwrite(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/landed"
    os.makedirs(src)
    jan = [fx.flight("A1", "EAAC", "EAAB", fx.ms(2019, 1, 2, 8), fx.ms(2019, 1, 2, 9))] * 2
    feb = [fx.flight("B1", "nan", "LAAD", fx.ms(2019, 2, 2, 8), fx.ms(2019, 2, 2, 9))]
    _csv(f"{src}/flightlist_20190101_20190131.csv.gz", jan)
    _csv(f"{src}/flightlist_20190201_20190228.csv.gz", feb)
    assert jobs.land_flight_files(spark, f"{src}/*.csv.gz", out) == 3
    mar = [fx.flight("C1", "EAAB", "EAAC", fx.ms(2019, 3, 2, 8), fx.ms(2019, 3, 2, 9))]
    _csv(f"{src}/flightlist_20190301_20190331.csv.gz", mar)
    assert jobs.land_flight_files(spark, f"{src}/*.csv.gz", out) == 1  # January and February are skipped
    assert jobs.land_flight_files(spark, f"{src}/*.csv.gz", out) == 0
    landed = spark.read.parquet(out)
    assert landed.count() == 4
    assert sorted(x for x in os.listdir(out) if x.startswith("dt=")) == ["dt=2019-01-01", "dt=2019-02-01", "dt=2019-03-01"]
    assert landed.filter("callsign = 'B1'").first().origin is None  # 'nan' token landed as null
    assert jobs.land_flight_files(spark, f"{src}/*.csv.gz", out, resume=False) == 4
    assert spark.read.parquet(out).count() == 4  # overwrite replaces the months, no duplicates


def test_unmatched_names_are_an_error_unless_skipping_is_asked_for(spark, tmp_dir, caplog):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/landed"
    os.makedirs(src)
    rows = [fx.flight("A1", "EAAC", "EAAB", fx.ms(2019, 1, 2, 8), fx.ms(2019, 1, 2, 9))]
    _csv(f"{src}/flightlist_20190101_20190131.csv.gz", rows * 3)
    _csv(f"{src}/extra.csv.gz", rows * 5)
    with pytest.raises(ValueError, match="extra.csv.gz"):
        jobs.land_flight_files(spark, f"{src}/*.csv.gz", out)
    assert not os.path.exists(out)
    assert jobs.land_flight_files(spark, f"{src}/*.csv.gz", out, unmatched="skip") == 3
    assert "5 rows" in caplog.text
    with pytest.raises(FileNotFoundError):
        jobs.land_flight_files(spark, f"{src}/nothing*.csv.gz", out)


def test_an_unreadable_landed_file_does_not_double_a_month(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/landed"
    os.makedirs(src)
    _csv(f"{src}/flightlist_20190101_20190131.csv.gz", [fx.flight("A1", "EAAC", "EAAB", fx.ms(2019, 1, 2, 8), fx.ms(2019, 1, 2, 9))] * 3)
    assert jobs.land_flight_files(spark, f"{src}/*.csv.gz", out) == 3
    with open(f"{out}/dt=2019-01-01/part-99999.parquet", "w") as f:
        f.write("not a table")
    assert jobs.land_flight_files(spark, f"{src}/*.csv.gz", out) == 0
    os.remove(f"{out}/dt=2019-01-01/part-99999.parquet")
    assert spark.read.parquet(out).count() == 3


def test_columns_are_found_by_name(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/landed"
    os.makedirs(src)
    names = schemas.FLIGHTS_RAW.fieldNames()
    row = dict(zip(names, fx.flight("A1", "EAAC", "EAAB", fx.ms(2019, 1, 2, 8), fx.ms(2019, 1, 2, 9)), strict=True))
    turned = [*reversed(names), "extra"]
    with gzip.open(f"{src}/flightlist_20190101_20190131.csv.gz", "wt") as f:
        f.write(",".join(turned) + "\n")
        f.write(",".join("" if row.get(n) is None else str(row[n]) for n in turned) + "\n")
    row["firstseen"], row["lastseen"] = "2019-01-02 08:00:00+00:00", "2019-01-02T09:00:00Z"
    with gzip.open(f"{src}/flightlist_20190201_20190228.csv.gz", "wt") as f:
        f.write(",".join(names) + "\n")
        f.write(",".join("" if row[n] is None else str(row[n]) for n in names) + "\n")
    assert jobs.land_flight_files(spark, f"{src}/*.csv.gz", out) == 2
    landed = spark.read.parquet(out).drop("dt").distinct().collect()
    assert len(landed) == 1 and landed[0].origin == "EAAC" and landed[0].firstseen == fx.ms(2019, 1, 2, 8)
    with gzip.open(f"{src}/flightlist_20190301_20190331.csv.gz", "wt") as f:
        f.write(",".join(names[1:]) + "\n")
    with pytest.raises(ValueError, match=names[0]):
        jobs.land_flight_files(spark, f"{src}/*.csv.gz", out)


def test_observation_and_reference_jobs(spark, tmp_dir):
    inp = fx.write(spark, f"{tmp_dir}/in")
    n = jobs.load_observation_files(spark, [inp.weather], f"{tmp_dir}/obs")
    assert n == len(fx.weather())
    assert any(p.startswith("obs_month=") for p in os.listdir(f"{tmp_dir}/obs"))
    fixed = jobs.harmonise_observation_files(spark, [[inp.weather]], f"{tmp_dir}/obs_fixed")
    assert fixed.schema["snowfall"].dataType.typeName() == "double"
    counts = jobs.land_reference_files(spark, inp.airports, inp.airlines, inp.routes, f"{tmp_dir}/ref")
    assert counts == {"airports": 5, "airlines": 5, "routes": 4}


def test_cli_build(spark, tmp_dir, capsys):
    inp = fx.write(spark, f"{tmp_dir}/in")
    rc = main(["build", inp.flights, inp.weather, inp.airports, inp.airlines, inp.routes, f"{tmp_dir}/out", "--seed", inp.hub_seed], spark=spark)
    assert rc == 0
    assert os.path.isdir(f"{tmp_dir}/out/hub_recovery")
