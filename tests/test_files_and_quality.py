import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.operators import quality as q
from brisa.sources import files
from brisa.streaming import landing

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()), T.StructField("x", T.DoubleType())])


def test_land_csv_gzip_null_tokens_and_file_month(spark, tmp_dir):
    d = f"{tmp_dir}/src"
    os.makedirs(d)
    with gzip.open(f"{d}/flightlist_20200301_20200331.csv.gz", "wt") as f:
        f.write("id,s,x\n1,nan,1.5\n2,,2.5\n3,None,\n4,ok,4.0\n")
    df = files.with_file_month(files.land_csv(spark, f"{d}/*.csv.gz", SCHEMA))
    got = sorted((r.id, r.s, r.x, r.dt) for r in df.collect())
    m = dt.date(2020, 3, 1)
    assert got == [(1, None, 1.5, m), (2, None, 2.5, m), (3, None, None, m), (4, "ok", 4.0, m)]


def test_only_new_and_overwrite_partitions(spark, tmp_dir):
    out = f"{tmp_dir}/t"
    a = spark.createDataFrame([(1, "2020-01"), (2, "2020-02")], "v int, dt string")
    files.write_partitioned(a, out, ["dt"])
    incoming = spark.createDataFrame([(3, "2020-02"), (4, "2020-03")], "v int, dt string")
    new = files.only_new_partitions(incoming, spark.read.parquet(out), "dt")
    assert [r.v for r in new.collect()] == [4]
    files.overwrite_partitions(spark.createDataFrame([(9, "2020-02")], "v int, dt string"), out, ["dt"])
    assert sorted((r.v, r.dt) for r in spark.read.parquet(out).collect()) == [(1, "2020-01"), (9, "2020-02")]


def test_read_harmonised_int64_beside_double(spark, tmp_dir):
    a, b = f"{tmp_dir}/a", f"{tmp_dir}/b"
    spark.createDataFrame([(1, 5)], "k int, m long").write.parquet(a)
    spark.createDataFrame([(2, 2.5)], "k int, m double").write.parquet(b)
    df = files.read_harmonised(spark, [[a], [b]], ["m"])
    assert df.schema["m"].dataType == T.DoubleType()
    assert sorted((r.k, r.m) for r in df.collect()) == [(1, 5.0), (2, 2.5)]


def test_explode_parallel_arrays_from_json_payload(spark, tmp_dir):
    p = f"{tmp_dir}/w.json"
    with open(p, "w") as f:
        json.dump({"airport_icao": "EAAC", "hourly": {"time": ["2019-01-01T00:00", "2019-01-01T01:00"], "snowfall": [0.0, 0.3]}}, f)
    schema = T.StructType(
        [
            T.StructField("airport_icao", T.StringType()),
            T.StructField("hourly", T.StructType([T.StructField("time", T.ArrayType(T.StringType())), T.StructField("snowfall", T.ArrayType(T.DoubleType()))])),
        ]
    )
    raw = spark.read.schema(schema).option("multiLine", True).json(p)
    out = files.explode_parallel_arrays(raw, "hourly", keep=["airport_icao"])
    assert sorted((r.airport_icao, r.time, r.snowfall, r.obs_date) for r in out.collect()) == [
        ("EAAC", "2019-01-01T00:00", 0.0, dt.date(2019, 1, 1)),
        ("EAAC", "2019-01-01T01:00", 0.3, dt.date(2019, 1, 1)),
    ]


def test_write_small_csv_checks_bound(spark, tmp_dir):
    with pytest.raises(ValueError):
        files.write_small_csv(spark.range(20), f"{tmp_dir}/x", max_rows=10)
    files.write_small_csv(spark.range(5), f"{tmp_dir}/y", max_rows=10)
    assert len([f for f in os.listdir(f"{tmp_dir}/y") if f.endswith(".csv")]) == 1


def test_load_summary_counts_during_write(spark, tmp_dir):
    assert files.load_summary(spark.range(123), f"{tmp_dir}/z") == 123


def test_write_layout_partitions_by_month(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.date(2019, 1, 5), "B"), (2, dt.date(2019, 1, 7), "A"), (3, dt.date(2019, 2, 1), "C")], "id int, d date, k string")
    files.write_layout(df, f"{tmp_dir}/l", "d", ["k"])
    parts = sorted(p for p in os.listdir(f"{tmp_dir}/l") if p.startswith("month="))
    assert parts == ["month=2019-01-01", "month=2019-02-01"]


def test_incremental_landing_exactly_once(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write("id,s,x\n1,a,1.0\n2,nan,2.0\n")
    assert landing.land_available(landing.read_new_csv(spark, src, SCHEMA), sink, ck) == 2
    with open(f"{src}/b.csv", "w") as f:
        f.write("id,s,x\n3,c,3.0\n")
    assert landing.land_available(landing.read_new_csv(spark, src, SCHEMA), sink, ck) == 1
    assert landing.land_available(landing.read_new_csv(spark, src, SCHEMA), sink, ck) == 0
    got = sorted((r.id, r.s) for r in spark.read.schema(SCHEMA).parquet(sink).collect())
    assert got == [(1, "a"), (2, None), (3, "c")]


def test_streaming_landing_counts_every_batch(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/many", f"{tmp_dir}/many-sink", f"{tmp_dir}/many-ck"
    os.makedirs(src)
    for i in range(110):
        with open(f"{src}/f{i:03d}.csv", "w") as f:
            f.write(",".join(SCHEMA.fieldNames()) + "\n" + ",".join("1" for _ in SCHEMA.fieldNames()) + "\n")
    stream = landing.read_new_csv(spark, src, SCHEMA, max_files_per_trigger=1)
    assert landing.land_available(stream, sink, ck) == 110
    assert spark.read.parquet(sink).count() == 110


def test_streaming_landing_raises_on_timeout(spark, tmp_dir):
    src = f"{tmp_dir}/slow"
    os.makedirs(src)
    for i in range(60):
        with open(f"{src}/f{i:03d}.csv", "w") as f:
            f.write(",".join(SCHEMA.fieldNames()) + "\n" + ",".join("1" for _ in SCHEMA.fieldNames()) + "\n")
    stream = landing.read_new_csv(spark, src, SCHEMA, max_files_per_trigger=1)
    with pytest.raises(TimeoutError):
        landing.land_available(stream, f"{tmp_dir}/slow-sink", f"{tmp_dir}/slow-ck", timeout_s=1)
    assert not spark.streams.active


def test_quality_checks_on_broken_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0, "clear"), (1, None, -1.0, "hail"), (2, "b", 50.0, "hail"), (None, "c", 10.0, None)],
        "id int, name string, v double, event string",
    )
    spec = q.RelationChecks(
        "t",
        not_null=["id", "name"],
        accepted={"event": ["clear", "snow"]},
        ranges=[q.RangeRule("v", 0, 20), q.RangeRule("v", 0, 20, row_condition=F.col("id") == 2, severity="warn")],
        mean_between={"v": (0, 10)},
        row_count_between=(5, 10),
    )
    got = [(r.check_name, r.column_name, r.failures, r.status) for r in q.relation_checks(df, spec).collect()]
    assert got == [
        ("not_null", "id", 1, "error"),
        ("not_null", "name", 1, "error"),
        ("accepted_values", "event", 1, "error"),  # one distinct bad value, nulls pass
        ("range", "v", 2, "error"),
        ("range", "v", 1, "warn"),
        ("mean_range", "v", 1, "error"),
        ("row_count", "*", 1, "error"),
    ]
    assert q.unique(df, "t", ["id"]).first().failures == 1
    assert q.unique(df.union(df.limit(0)), "t", ["id", "name"]).first().failures == 0
    parent = spark.createDataFrame([(1,)], "pid int")
    fk = q.relationships(df, "t", "id", parent, "pid", severity="warn").first()
    assert (fk.failures, fk.status) == (1, "warn")
    s = {r.status: r.n_checks for r in q.summary([q.relation_checks(df, spec), q.unique(df, "t", ["name"])]).collect()}
    assert s == {"error": 6, "warn": 1, "pass": 1}


def test_harmonised_finds_the_groups_and_reads_nanoseconds(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(f"{tmp_dir}/drift")
    when = [1_552_176_000_000_000_000, 1_552_179_600_000_000_123]
    pq.write_table(pa.table({"station": ["A", "B"], "obs_time": pa.array(when, pa.timestamp("ns")), "m": pa.array([1, 2], pa.int64())}), f"{tmp_dir}/drift/a.parquet")
    pq.write_table(pa.table({"station": ["C"], "obs_time": pa.array([7], pa.int64()), "m": pa.array([0.5], pa.float64())}), f"{tmp_dir}/drift/b.parquet")
    pq.write_table(pa.table({"station": ["D"], "obs_time": pa.array([8], pa.int64()), "m": pa.array([3], pa.int32())}), f"{tmp_dir}/drift/c.parquet")
    schema = T.StructType([T.StructField("station", T.StringType()), T.StructField("obs_time", T.LongType()), T.StructField("m", T.DoubleType())])
    before = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong")
    got = sorted(tuple(r) for r in files.read_harmonised(spark, f"{tmp_dir}/drift", ["m"], schema).collect())
    assert got == [("A", when[0], 1.0), ("B", when[1], 2.0), ("C", 7, 0.5), ("D", 8, 3.0)]
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == before


def test_foreign_keys_and_accepted_values_without_expand(spark):
    child = spark.createDataFrame([("x", 1)] * 5 + [("y", 2)] * 3 + [(None, 3)], "k string, v int")
    parent = spark.createDataFrame([("x",)], "k string")
    assert q.relationships(child, "c", "k", parent, "k").first().failures == 3
    assert q.relationships(child.filter("k = 'x'"), "c", "k", parent, "k").first().failures == 0
    spec = q.RelationChecks("c", not_null=["k"], accepted={"k": ["x"], "v": [1]})
    checks = q.relation_checks(child, spec)
    assert "Expand" not in checks._jdf.queryExecution().toString()
    assert {(r.check_name, r.column_name): r.failures for r in checks.collect()} == {
        ("not_null", "k"): 1,
        ("accepted_values", "k"): 1,
        ("accepted_values", "v"): 2,
    }
