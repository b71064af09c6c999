"""File ledger: late, replaced and half-landed files; headers and footers in a fixed number of jobs."""

import gzip
import os
import shutil
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.sources import files, jobs, ledger, probe

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])


def write(folder, name, rows, header="a,n", days_ago=0):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with gzip.open(path, "wt") as f:
        f.write("\n".join([header, *[f"{a},{n}" if header == "a,n" else f"{n},{a}" for a, n in rows]]) + "\n")
    stamp = time.time() - 86400 * days_ago
    os.utime(path, (stamp, stamp))


def content(spark, out):
    return sorted((str(r["dt"]), r["a"], r["n"]) for r in spark.read.parquet(out).collect())


def rows_in_ledger(spark, out):
    return {os.path.basename(r["path"]): (str(r["dt"]), r["rows"]) for r in ledger.landed(spark, out).collect()}


JAN, JAN2, FEB = "flightlist_20190101_20190131.csv.gz", "flightlist_20190101_20190131-late.csv.gz", "flightlist_20190201_20190228.csv.gz"


@pytest.fixture()
def place(tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    write(src, JAN, [("x", 1), ("x", 1), ("y", 2)], days_ago=3)
    write(src, FEB, [("z", 3)], header="n,a", days_ago=2)
    return src, out


def test_a_late_file_of_a_landed_month_lands(spark, place):
    src, out = place
    assert jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA) == 4
    write(src, JAN2, [("late", 9)])
    assert jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA) == 1
    assert jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA) == 0
    assert content(spark, out) == [("2019-01-01", "late", 9), ("2019-01-01", "x", 1), ("2019-01-01", "x", 1), ("2019-01-01", "y", 2), ("2019-02-01", "z", 3)]
    assert rows_in_ledger(spark, out) == {JAN: ("2019-01-01", 3), JAN2: ("2019-01-01", 1), FEB: ("2019-02-01", 1)}


def test_a_replaced_file_takes_the_place_of_its_earlier_state(spark, place):
    src, out = place
    write(src, JAN2, [("late", 9)], days_ago=1)
    jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA)
    write(src, JAN, [("new", 5)])
    os.remove(f"{src}/{FEB}")  # a removed source keeps its rows
    assert jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA) == 1
    assert content(spark, out) == [("2019-01-01", "late", 9), ("2019-01-01", "new", 5), ("2019-02-01", "z", 3)]
    assert rows_in_ledger(spark, out)[JAN] == ("2019-01-01", 1)


class Killed(Exception):
    pass


@pytest.mark.parametrize("at", ["commit", "publish", "move", "remove"])
def test_a_killed_run_is_made_good(spark, place, monkeypatch, at):
    src, out = place
    jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA)
    write(src, JAN2, [("late", 9), ("late", 9)])
    write(src, FEB, [("other", 4)])
    moved = []

    def die(*args, **more):
        moved.append(args)
        if at not in ("move", "remove") or len(moved) > 1:
            raise Killed
        return originals[at](*args)

    originals = {"move": ledger._Folder.move, "remove": ledger._Folder.remove}
    with monkeypatch.context() as m:
        m.setattr(ledger._Folder if at in originals else ledger, at, die)
        with pytest.raises(Killed):
            jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA)
    if at == "commit":
        # Nothing of the killed run shows, not even in a plain read.
        assert content(spark, out)[-1] == ("2019-02-01", "z", 3) and ledger.landed(spark, out).count() == 2
    written = jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA)
    assert written == (3 if at == "commit" else 0)
    assert content(spark, out) == [
        ("2019-01-01", "late", 9), ("2019-01-01", "late", 9), ("2019-01-01", "x", 1), ("2019-01-01", "x", 1), ("2019-01-01", "y", 2), ("2019-02-01", "other", 4)
    ]
    assert rows_in_ledger(spark, out) == {JAN: ("2019-01-01", 3), JAN2: ("2019-01-01", 2), FEB: ("2019-02-01", 1)}
    assert os.listdir(f"{out}/_staging") == []


def test_replacing_months_and_empty_files(spark, place):
    src, out = place
    jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA)
    write(f"{src}/b", JAN2, [("only", 1)])
    assert jobs.land_files(spark, f"{src}/b/*.gz", out, SCHEMA, resume=False) == 1
    assert content(spark, out) == [("2019-01-01", "only", 1), ("2019-02-01", "z", 3)]
    write(f"{src}/c", FEB, [])
    open(f"{src}/c/flightlist_20190301_20190331.csv", "w").close()
    assert jobs.land_files(spark, f"{src}/c/*", out, SCHEMA) == 0
    assert jobs.land_files(spark, f"{src}/c/*", out, SCHEMA) == 0
    # A file of no bytes is not in the listing.
    assert ledger.entries(spark, out).filter(F.col("path").contains("/c/")).count() == 1
    assert len(content(spark, out)) == 2


def test_months_landed_without_a_ledger_are_not_guessed_at(spark, place):
    src, out = place
    jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA)
    shutil.rmtree(f"{out}/_ledger")
    write(src, JAN2, [("late", 9)])
    with pytest.raises(ValueError, match="2019-01-01"):
        jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA)
    ledger.adopt(ledger.listing(spark, [f"{src}/{JAN}", f"{src}/{FEB}"], jobs.name_month), out)
    assert jobs.land_files(spark, f"{src}/*.gz", out, SCHEMA) == 1
    assert len(content(spark, out)) == 5


def jobs_of(spark, action):
    """How many Spark jobs an action runs."""
    tracker, group = spark.sparkContext.statusTracker(), f"count-{time.time()}"
    spark.sparkContext.setJobGroup(group, "")
    action()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_files(spark, tmp_dir):
    counts = {}
    for n in (6, 500):
        for kind in ("csv", "parquet"):
            os.makedirs(f"{tmp_dir}/{kind}{n}")
        for k in range(n):
            with open(f"{tmp_dir}/csv{n}/f [{k}] é%20.csv", "w") as f:
                f.write("\n\na,n\nx,1\n" if k % 2 else "n,more,a\r\n1,,x\r\n")
            kind = pa.int64() if k % 3 == 0 else pa.float64() if k % 3 == 1 else pa.timestamp("ns")
            pq.write_table(pa.table({"a": ["x"], "n": pa.array([1], kind)}), f"{tmp_dir}/parquet{n}/f {k}.parquet")
        found = {}
        counts[n] = (
            jobs_of(spark, lambda: found.update(csv=probe.header_groups(spark, f"{tmp_dir}/csv{n}"))),
            jobs_of(spark, lambda: found.update(parquet=probe.type_groups(spark, f"{tmp_dir}/parquet{n}"))),
        )
        assert sorted((names, len(paths)) for names, paths in found["csv"]) == [(["a", "n"], n // 2), (["n", "more", "a"], n // 2)]
        assert sorted((s["n"].dataType.simpleString(), len(p)) for s, p in found["parquet"]) == sorted(
            [("bigint", len(range(0, n, 3))), ("double", len(range(1, n, 3))), ("bigint", len(range(2, n, 3)))]
        )
        assert files.read_csv(spark, f"{tmp_dir}/csv{n}", SCHEMA).distinct().collect() == [("x", 1)]
        assert files.read_harmonised(spark, f"{tmp_dir}/parquet{n}", ["n"]).agg(F.count("n"), F.sum("n")).first() == (n, float(n))
    assert counts[6] == counts[500] and max(counts[6]) <= 8
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == "false"


def test_files_that_only_spark_can_open(spark, tmp_dir, monkeypatch):
    """The binaryFile source stands in where pyarrow knows no file system."""
    write(tmp_dir, "one.csv.gz", [("x", 1)])
    look = probe.grouped(spark, f"{tmp_dir}/*.gz", probe.first_line)
    seen = probe._seen(spark.read.format("binaryFile").load(f"{tmp_dir}/*.gz").select("path", "content"), probe.first_line).collect()
    assert [(r["found"], r["problem"]) for r in seen] == [("a,n", None)] == [(f, None) for f, _ in look]
    unknown = spark.createDataFrame([("nowhere://host/x.csv",)], "path string")
    row = probe._seen(unknown, probe.first_line).first()
    assert row["found"] is None and row["problem"]
