import datetime as dt

from pyspark.sql import functions as F

from brisa import functions as bf
from brisa.functions.classify import WEATHER_RULES, classify


def test_sunday_week_matches_strftime_u(spark):
    # Week number with Sunday first; days before the first Sunday are week 0.
    days = spark.range(0, 1461).select(F.date_add(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    got = {r.d: r.w for r in days.select("d", bf.sunday_week("d").alias("w")).collect()}
    assert len(got) == 1461
    for d, w in got.items():
        assert w == int(d.strftime("%U")), d


def test_safe_timestamp_millis_bounds(spark):
    df = spark.createDataFrame([(0,), (253402300799999,), (253402300800000,), (-62135596800001,), (None,)], "ms long")
    out = [r.t for r in df.select(bf.safe_timestamp_millis("ms").alias("t")).collect()]
    assert out[0] is not None and out[1] is not None
    assert out[2] is None and out[3] is None and out[4] is None


def test_nanos_to_timestamp_is_exact(spark):
    # 2019-06-01T12:34:56.123456 plus 789 ns: a double would lose the last microsecond.
    micros = 1559392496123456
    df = spark.createDataFrame([(micros * 1000 + 789,)], "ns long")
    got = df.select(F.unix_micros(bf.nanos_to_timestamp("ns")).alias("us")).first().us
    assert got == micros


def test_surrogate_key_null_safe_and_deterministic(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, "a"), ("a", "")], "x string, y string")
    keys = [r.k for r in df.select(bf.surrogate_key("x", "y").alias("k")).collect()]
    assert keys[0] == keys[1]
    assert len({keys[0], keys[2], keys[3]}) == 3


def test_null_sentinel_and_tokens(spark):
    df = spark.createDataFrame([(" \\N ",), ("X",), ("nan",), ("",), (None,)], "s string")
    r = df.select(bf.null_sentinel("s").alias("a"), bf.normalize_nulls("s").alias("b")).collect()
    assert [x.a for x in r] == [None, "X", "nan", "", None]
    assert [x.b for x in r] == [" \\N ", "X", None, None, None]


def test_flag_equals_three_valued(spark):
    df = spark.createDataFrame([("Y",), (" N",), (None,)], "s string")
    r = df.select(bf.flag_equals("s", "Y").alias("a"), bf.flag_equals("s", "Y", null_as=False).alias("b")).collect()
    assert [x.a for x in r] == [True, False, None]
    assert [x.b for x in r] == [True, False, False]


def test_safe_divide_zero_and_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 2)], "a long, b long")
    assert [r.q for r in df.select(bf.safe_divide("a", "b").alias("q")).collect()] == [None, None, 1.5]
    dfd = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert dfd.select(bf.safe_divide("a", "b").alias("q")).first().q is None


def test_round_half_up_on_shortest_decimal(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (2.5,), (-2.5,)], "x double")
    r = [x.r for x in df.select(F.round("x", 2).alias("r")).collect()]
    assert r == [1.01, 0.29, 2.5, -2.5]


def test_minutes_between_is_double_not_decimal(spark):
    df = spark.createDataFrame([(0, 5400000)], "a long, b long").select(bf.minutes_between("a", "b").alias("m"))
    assert df.schema["m"].dataType.typeName() == "double"
    assert df.first().m == 90.0


def test_classify_precedence_thresholds_and_nulls(spark):
    cols = "snowfall double, wind_gusts_10m double, surface_pressure double, wind_speed_10m double, relative_humidity_2m double, cloud_cover double, matched boolean"
    rows = [
        (0.1, 25.0, 980.0, 12.0, 95.0, 90.0, True),  # snow wins over everything
        (0.0, 25.0, 980.0, 12.0, 95.0, 90.0, True),  # storm before windy
        (0.0, 20.0, 990.0, 10.0, 95.0, 90.0, True),  # exactly on thresholds: not storm/windy(speed); gusts 20 > 15 -> windy
        (0.0, 15.0, 990.0, 10.0, 90.0, 80.0, True),  # all exactly on thresholds -> clear
        (0.0, 15.0, 990.0, 10.0, 90.5, 80.5, True),  # fog
        (None, None, None, None, None, None, True),  # null measures fall through -> clear
        (None, None, None, None, None, None, False),  # no observation -> null
        (0.0, None, 985.0, 11.0, None, None, True),  # null gust: storm unknown, speed > 10 -> windy
    ]
    df = spark.createDataFrame(rows, cols)
    got = [r.e for r in df.select(classify(WEATHER_RULES, F.col("matched")).alias("e")).collect()]
    assert got == ["snow", "storm", "windy", "clear", "fog", "clear", None, "windy"]


def test_in_year_pushes_both_bounds(spark, tmp_dir):
    p = f"{tmp_dir}/d"
    spark.createDataFrame([(dt.date(2019, 5, 1),), (dt.date(2020, 1, 1),)], "d date").write.parquet(p)
    df = spark.read.parquet(p).filter(bf.in_year("d", 2019))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d" in plan and "LessThan(d" in plan
    assert df.count() == 1


def test_file_month_from_name(spark):
    df = spark.createDataFrame([("flightlist_20200301_20200331.csv.gz",), ("other.csv",)], "f string")
    r = [x.m for x in df.select(bf.file_month("f").alias("m")).collect()]
    assert r == [dt.date(2020, 3, 1), None]


def test_pearson_null_instead_of_error(spark):
    from brisa.functions import pearson

    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "x double, y double")
    assert one.agg(pearson("x", "y").alias("r")).first().r is None
    assert const.agg(pearson("x", "y").alias("r")).first().r is None
    r = line.agg(pearson("x", "y").alias("r"), F.corr("x", "y").alias("c")).first()
    assert abs(r.r - r.c) < 1e-12


def test_cluster_conf_sizes_partitions():
    from brisa.session import cluster_conf

    conf = cluster_conf(100 * 10**12, cores=8000)
    assert 350_000 < int(conf["spark.sql.shuffle.partitions"]) < 400_000
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(10**6, cores=16)["spark.sql.shuffle.partitions"]) == 32
