import datetime as dt

from pyspark.sql import functions as F

from brisa import operators as op
from brisa.operators.aggregates import profile_stats


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_latest_total_order_on_ties(spark):
    # Two rows tie on the order column; the tie-break on the remaining columns decides (T4).
    rows = [("k", 5, "b"), ("k", 5, "a"), ("k", 3, "z"), ("j", 1, "q")]
    df = spark.createDataFrame(rows, "key string, ts int, payload string")
    for _ in range(3):
        out = {r.key: (r.ts, r.payload) for r in op.dedup_latest(df.repartition(3), ["key"], [F.col("ts").desc()]).collect()}
        assert out == {"k": (5, "a"), "j": (1, "q")}


def test_dedup_plans_window_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = _plan(op.dedup_latest(df, ["k"], [F.col("v").desc()]))
    assert "WindowGroupLimit" in plan


def test_first_per_key_lowest_id(spark):
    df = spark.createDataFrame([("AAL", 3, "x"), ("AAL", 1, "y"), ("BAW", 2, "z")], "carrier string, carrier_id int, n string")
    out = {r.carrier: r.carrier_id for r in op.first_per_key(df, "carrier", "carrier_id").collect()}
    assert out == {"AAL": 1, "BAW": 2}


def test_mode_per_key_tie_goes_to_smallest_tuple(spark):
    rows = [("a1", "R1", "T1"), ("a1", "R2", "T1"), ("a1", "R2", "T1"), ("a2", "R9", "T1"), ("a2", "R3", "T1"), ("a3", None, "T2")]
    df = spark.createDataFrame(rows, "asset string, reg string, typ string")
    out = {r.asset: (r.reg, r.typ, r.obs_count) for r in op.mode_per_key(df, "asset", ["reg", "typ"]).collect()}
    assert out == {"a1": ("R2", "T1", 2), "a2": ("R3", "T1", 1), "a3": (None, "T2", 1)}


def test_touches_any_and_flags_are_broadcast(spark):
    facts = spark.createDataFrame([(1, "H1", "X"), (2, "X", "H2"), (3, "X", "Y"), (4, None, "H1"), (5, None, None)], "id int, o string, d string")
    hubs = spark.createDataFrame([("H1",), ("H2",), ("H2",)], "station string")
    out = op.touches_any(facts, ["o", "d"], hubs, "station")
    assert sorted(r.id for r in out.collect()) == [1, 2, 4]
    assert "BroadcastHashJoin" in _plan(out)
    flagged = op.with_membership_flag(facts, "o", hubs, "station", "is_hub")
    assert {r.id: r.is_hub for r in flagged.collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_time_bucket_join_one_to_one_after_collapse(spark):
    facts = spark.createDataFrame(
        [(1, "H", dt.datetime(2019, 1, 1, 10, 15)), (2, "H", dt.datetime(2019, 1, 1, 12, 0)), (3, None, dt.datetime(2019, 1, 1, 10, 0))],
        "id int, st string, ts timestamp",
    )
    obs = spark.createDataFrame(
        [("H", dt.datetime(2019, 1, 1, 10, 0), 1.0), ("H", dt.datetime(2019, 1, 1, 10, 0), 3.0), ("H", dt.datetime(2019, 1, 1, 11, 0), 9.0)],
        "station string, observation_hour timestamp, m double",
    )
    grid = op.collapse_duplicates(obs, ["station", "observation_hour"], ["m"])
    out = op.time_bucket_join(facts, grid, "st", "ts", ["m"], "o_")
    got = {r.id: (r.o_m, r.o_matched) for r in out.collect()}
    assert got == {1: (2.0, True), 2: (None, False), 3: (None, False)}


def test_bucket_join_spreads_facts_without_a_key(spark):
    import datetime as dt

    hour = dt.datetime(2019, 1, 1, 10, 0)
    facts = spark.createDataFrame([(i, None if i % 2 else "H", None if i % 3 == 0 else hour) for i in range(600)], "id int, st string, ts timestamp")
    obs = spark.createDataFrame([("H", hour, 2.0), (None, hour, 9.0), ("H", None, 9.0)], "station string, observation_hour timestamp, m double")
    out = op.time_bucket_join(facts, obs.hint("merge"), "st", "ts", ["m"], "o_")
    assert "SortMergeJoin" in _plan(out)
    rows = out.collect()
    assert len(rows) == 600 and out.columns == ["id", "st", "ts", "o_m", "o_matched"]
    assert all(r.o_matched == (r.id % 2 == 0 and r.id % 3 != 0) and r.o_m == (2.0 if r.o_matched else None) for r in rows)


def test_full_outer_counts_zero_fill(spark):
    a = spark.createDataFrame([("H1", 1, 5), ("H2", 1, 2)], "hub string, m int, n long")
    b = spark.createDataFrame([("H1", 1, 3), ("H3", 2, 4)], "hub string, m int, n long")
    j = op.full_outer_counts(a.withColumnRenamed("n", "dep"), b.withColumnRenamed("n", "arr"), ["hub", "m"], "dep", "arr", "tot")
    got = {(r.hub, r.m): (r.dep, r.arr, r.tot) for r in j.collect()}
    assert got == {("H1", 1): (5, 3, 8), ("H2", 1): (2, 0, 2), ("H3", 2): (0, 4, 4)}


def test_baseline_join_same_calendar_month(spark):
    facts = spark.createDataFrame([("H", dt.date(2020, 3, 1), 5), ("H", dt.date(2019, 3, 1), 10), ("H", dt.date(2020, 4, 1), 1)], "hub string, month date, n long")
    base = spark.createDataFrame([("H", 3, 10)], "hub string, cm int, base long")
    out = {r.month: r.base for r in op.baseline_join(facts, base, ["hub"], "month", "cm", ["base"]).collect()}
    assert out == {dt.date(2020, 3, 1): 10, dt.date(2019, 3, 1): 10, dt.date(2020, 4, 1): None}


def test_range_lookup_left_and_outside(spark):
    from brisa.sources.lookups import phases

    df = spark.createDataFrame([(dt.date(2020, 6, 30),), (dt.date(2020, 7, 1),), (dt.date(2018, 1, 1),)], "d date")
    out = {r.d: r.phase for r in op.range_lookup(df, "d", phases(spark), "phase_start_date", "phase_end_date").collect()}
    assert out == {dt.date(2020, 6, 30): "collapse", dt.date(2020, 7, 1): "restricted", dt.date(2018, 1, 1): None}


def test_movements_one_pass_with_hub_semi_join(spark):
    facts = spark.createDataFrame([(1, "H1", "H2", "e1", "e2"), (2, "H1", "X", "e3", None), (3, "X", "Y", None, None)], "id int, o string, d string, oe string, de string")
    hubs = spark.createDataFrame([("H1",), ("H2",)], "station string")
    out = op.movements(facts, [{"hub": "o", "event": "oe"}, {"hub": "d", "event": "de"}], carry=["id"], hubs=hubs)
    plan = _plan(out)  # before execution: the adaptive plan then prints one tree only
    got = sorted((r.id, r.hub, r.event, r.end_index) for r in out.collect())
    assert got == [(1, "H1", "e1", 0), (1, "H2", "e2", 1), (2, "H1", "e3", 0)]
    assert plan.count("Scan ExistingRDD[id") == 1  # the facts are read once


def test_top_n_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 3), ("b", 3), ("c", None), ("d", 5)], "k string, v int")
    assert [r.k for r in op.top_n(df, "v", 3, ["k"]).collect()] == ["d", "a", "b"]
    assert "TakeOrderedAndProject" in _plan(op.top_n(df, "v", 2, ["k"]))


def test_profile_stats_single_row_and_quantiles(spark):
    rows = [("g1", float(v)) for v in range(1, 11)] + [("g2", 7.0)]
    df = spark.createDataFrame(rows, "g string, duration double")
    out = {r.g: r for r in profile_stats(df, ["g"], "duration").collect()}
    assert out["g1"].total_movements == 10 and out["g1"].p50_duration == 5.0 and out["g1"].p95_duration == 10.0
    assert out["g1"].avg_duration == 5.5
    assert out["g2"].stddev_duration is None and out["g2"].p50_duration == 7.0


def test_avg_of_counts_two_levels(spark):
    df = spark.createDataFrame([("r", "d1"), ("r", "d1"), ("r", "d2"), ("s", "d1")], "route string, day string")
    out = op.avg_of_counts(df, ["route", "day"], ["route"], [F.avg("n").alias("avg_daily"), F.sum("n").alias("total")])
    assert {r.route: (r.avg_daily, r.total) for r in out.collect()} == {"r": (1.5, 3), "s": (1.0, 1)}


def test_materialise_view_and_table(spark, tmp_dir):
    from brisa.sources.files import materialise

    df = spark.range(5)
    materialise(df, "v_five")
    assert spark.table("v_five").count() == 5
    t = materialise(df, "t_five", kind="table", path=f"{tmp_dir}/t")
    assert t.count() == 5 and "Scan parquet" in _plan(t)


def test_date_dimension_reference_window(spark):
    from brisa.plans.dims import dim_date

    d = dim_date(spark)  # 2019-01-01 .. 2022-12-31
    assert d.count() == 1461
    r = {x.date_day: x for x in d.filter(F.col("date_day").isin(dt.date(2019, 1, 5), dt.date(2019, 1, 6), dt.date(2020, 2, 29))).collect()}
    sat, sun, leap = r[dt.date(2019, 1, 5)], r[dt.date(2019, 1, 6)], r[dt.date(2020, 2, 29)]
    assert (sat.day_of_week, sat.week_of_year, sat.is_weekend, sat.day_name) == (7, 0, True, "Saturday")
    assert (sun.day_of_week, sun.week_of_year) == (1, 1)
    assert (leap.quarter_of_year, leap.month_name, leap.quarter_start_date, leap.month_start_date) == (1, "February", dt.date(2020, 1, 1), dt.date(2020, 2, 1))


def test_phase_layout_relative_to_base_year(spark):
    from brisa.sources.lookups import PHASES_2019, phase_rows

    assert [r[:3] for r in phase_rows(2019)] == [r[:3] for r in PHASES_2019]


def test_time_bucket_join_shuffle_fallback_with_hot_key(spark):
    # A third of the facts on one station: the unbroadcast path (no broadcast
    # by estimate) must give the same rows as the broadcast path.
    facts = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") % 50).cast("string"))).alias("st"),
        (F.lit(dt.datetime(2019, 1, 1)).cast("timestamp") + F.make_interval(hours=(F.col("id") % 24).cast("int"))).alias("ts"),
    )
    grid = spark.range(50 * 24).select(
        F.when(F.col("id") < 24, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") / 24).cast("int").cast("string"))).alias("station"),
        (F.lit(dt.datetime(2019, 1, 1)).cast("timestamp") + F.make_interval(hours=(F.col("id") % 24).cast("int"))).alias("observation_hour"),
        (F.col("id") * 1.0).alias("m"),
    )
    a = op.time_bucket_join(facts, grid, "st", "ts", ["m"], "o_", broadcast=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = op.time_bucket_join(facts, grid, "st", "ts", ["m"], "o_")
        assert "BroadcastHashJoin" not in _plan(b)
        key = lambda r: (r.id, r.o_m, r.o_matched)
        assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
        assert a.filter("o_matched").count() == b.filter("o_matched").count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
