"""Hot bucket pairs are split over tasks; range joins compare no row with every range."""

import datetime as dt
import random
from collections import Counter
from contextlib import contextmanager
from statistics import median

import pytest
from pyspark.sql import functions as F

from brisa import operators as op
from brisa.operators.joins import HOT_KEYS


@contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def facts_and_grid(spark):
    """Half of the facts on one pair at the origin, a third on another at the destination; some ends null or unmatched."""
    hour = dt.datetime(2019, 1, 1)
    n = F.col("id")
    at = F.timestamp_seconds(F.lit(int(hour.replace(tzinfo=dt.timezone.utc).timestamp())) + n % 7000 * 3600)
    facts = spark.range(60_000).select(
        n.alias("id"),
        F.when(n % 2 == 0, "HOT").when(n % 101 == 0, None).otherwise(F.concat(F.lit("s"), n % 40)).alias("a"),
        F.when(n % 2 == 0, F.lit(hour)).otherwise(at).alias("at"),
        F.when(n % 3 == 0, "WARM").otherwise(F.concat(F.lit("s"), n % 50)).alias("b"),
        F.when(n % 3 == 0, F.lit(hour)).when(n % 103 == 0, None).otherwise(at).alias("bt"),
    )
    hours = spark.range(7000).select(F.timestamp_seconds(F.lit(int(hour.replace(tzinfo=dt.timezone.utc).timestamp())) + F.col("id") * 3600).alias("observation_hour"))
    stations = spark.createDataFrame([(f"s{k}",) for k in range(1, 50, 4)] + [("HOT",), ("WARM",)], "station string")
    return facts, hours.crossJoin(stations).withColumn("m", F.hash("station", "observation_hour").cast("double"))


def two_ends(facts, grid, split):
    hot = [op.hot_buckets(facts, s, t) if split else None for s, t in (("a", "at"), ("b", "bt"))]
    out = op.time_bucket_join(facts, grid, "a", "at", ["m"], "o_", hot=hot[0])
    return out, op.time_bucket_join(out, grid, "b", "bt", ["m"], "d_", hot=hot[1])


def test_half_the_facts_on_one_pair(spark):
    facts, grid = facts_and_grid(spark)
    settings = {"spark__sql__adaptive__enabled": "false", "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__shuffle__partitions": "16"}
    with conf(spark, **settings):
        for split in (True, False):
            for joined in two_ends(facts, grid.hint("merge"), split):
                loads = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect()]
                loads += [0] * (16 - len(loads))
                assert (max(loads) <= 2 * median(loads)) == split, loads
        plain, cut = (two_ends(facts, grid, split)[1].orderBy("id").collect() for split in (False, True))
    assert plain == cut and len(cut) == 60_000
    assert sum(r.o_matched for r in cut) > 30_000


def test_hot_buckets_are_few_and_cut_by_their_share(spark):
    facts, _ = facts_and_grid(spark)
    found = op.hot_buckets(facts, "a", "at", tasks=10).collect()
    assert 1 <= len(found) <= HOT_KEYS
    assert max(r.pieces for r in found) == pytest.approx(320, rel=0.05)
    assert op.hot_buckets(facts.filter("id < 0"), "a", "at").collect() == []
    assert op.hot_buckets(facts.withColumn("a", F.lit(None).cast("string")), "a", "at").collect() == []


def ranges_of(rng, n, kind):
    out = []
    for k in range(n):
        low = rng.randrange(-3000, 3000)
        length = rng.choice([0, 1, 2, 3, 7, 8, 100, 5000, -1])
        out.append((k, None if k % 17 == 3 else kind(low), None if k % 19 == 5 else kind(low + length), k % 3))
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize(
    ("kind", "name"),
    [
        (lambda x: x, "long"),
        (lambda x: dt.date(2000, 1, 1) + dt.timedelta(x), "date"),
        (lambda x: dt.datetime(2000, 1, 1) + dt.timedelta(hours=x, microseconds=x), "timestamp"),
        (lambda x: dt.datetime(1969, 12, 31) + dt.timedelta(microseconds=x), "timestamp_ntz"),
    ],
)
def test_interval_join_is_the_nested_loop(spark, kind, name, how):
    rng = random.Random(4)
    ranges = ranges_of(rng, 120, kind)
    points = [(k, None if k % 23 == 1 else kind(rng.randrange(-3100, 3100) if k % 4 else 5), k % 4) for k in range(150)]
    p = spark.createDataFrame(points, f"id int, at {name}, g int")
    r = spark.createDataFrame(ranges, f"rid int, low {name}, high {name}, h int")
    for keyed in (False, True):
        out = op.interval_join(p, r, "at", "low", "high", on=[("g", "h")] if keyed else [], how=how)
        assert out.columns == ["id", "at", "g", "rid", "low", "high", "h"]
        expected = Counter()
        for a in points:
            hits = [b for b in ranges if None not in (a[1], b[1], b[2]) and b[1] <= a[1] <= b[2] and (not keyed or a[2] == b[3])]
            expected.update((a[0], b[0]) for b in hits)
            expected.update([(a[0], None)] if how == "left" and not hits else [])
        assert Counter((x.id, x.rid) for x in out.collect()) == expected


def test_a_million_ranges_and_a_million_points(spark):
    """No nested loop; short and very long ranges together."""
    points = spark.range(1_000_000).select((F.col("id") * 7919 % 50_000_000).alias("at"))
    ranges = spark.range(1_000_000).select(
        F.col("id").alias("rid"), (F.col("id") * 104_729 % 50_000_000).alias("low"), F.when(F.col("id") % 250_000 == 0, 40_000_000).otherwise(F.col("id") % 30).alias("n")
    )
    ranges = ranges.select("rid", "low", (F.col("low") + F.col("n")).alias("high"))
    out = op.interval_join(points, ranges, "at", "low", "high")
    plan = out._jdf.queryExecution().toString()
    # The one-row side that lists the widths is the only nested loop.
    assert plan.split("== Physical Plan ==")[1].count("NestedLoopJoin") == 1 and "CartesianProduct" not in plan
    import numpy as np

    at = np.sort(np.arange(1_000_000) * 7919 % 50_000_000)
    rid = np.arange(1_000_000)
    low = rid * 104_729 % 50_000_000
    high = low + np.where(rid % 250_000 == 0, 40_000_000, rid % 30)
    assert out.count() == int((np.searchsorted(at, high, "right") - np.searchsorted(at, low, "left")).sum())


def test_interval_join_refuses_what_it_cannot_order(spark):
    p, r = spark.createDataFrame([(1.5,)], "at double"), spark.createDataFrame([(1.0, 2.0)], "low double, high double")
    with pytest.raises(TypeError):
        op.interval_join(p, r, "at", "low", "high")
    with pytest.raises(TypeError):
        op.interval_join(p.selectExpr("cast(at as long) at"), r, "at", "low", "high")
    empty = spark.createDataFrame([], "low long, high long")
    assert op.interval_join(p.selectExpr("cast(at as long) at"), empty, "at", "low", "high", how="left").collect() == [(1, None, None)]


def test_range_lookup_compares_with_literal_lookups_only(spark):
    days = spark.range(100).select(F.date_add(F.lit(dt.date(2019, 1, 1)), F.col("id").cast("int")).alias("d"))
    rows = [(k, dt.date(2019, 1, 1) + dt.timedelta(10 * k), dt.date(2019, 1, 9) + dt.timedelta(10 * k)) for k in range(8)]
    ranges = spark.createDataFrame(rows, "k int, low date, high date")
    expected = {dt.date(2019, 1, 1) + dt.timedelta(i): i // 10 if i < 80 and i % 10 < 9 else None for i in range(100)}
    for literal in (True, False):
        out = op.range_lookup(days, "d", ranges, "low", "high", literal=literal)
        assert ("__bucket" in out._jdf.queryExecution().toString()) != literal
        assert {r.d: r.k for r in out.collect()} == expected


def test_windows_meet_days_not_orders(spark, tmp_path, monkeypatch):
    """Parts and orders repeat, keys and dates are null; the pairs are at most one per part row and day."""
    import duckdb

    from brisa.plans import catalog

    day = [dt.datetime(1995, 1, 1, 7), dt.datetime(1995, 2, 20, 9), dt.datetime(1995, 2, 21), None]
    orders = spark.range(8000).select(
        F.when(F.col("id") % 97 != 0, F.col("id") % 5000).alias("o_orderkey"),
        F.element_at(F.array(*[F.lit(d).cast("timestamp_ntz") for d in day]), (F.col("id") % 4 + 1).cast("int")).alias("o_orderdate"),
    )
    part = spark.range(400).select(
        F.when(F.col("id") % 41 != 0, F.col("id") % 250).alias("p_partkey"), F.when(F.col("id") % 7 != 0, F.col("id") % 30).cast("int").alias("p_size")
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    part.write.parquet(f"{tmp_path}/part.parquet")
    seen = []
    monkeypatch.setattr(catalog, "interval_join", lambda *a, **k: seen.append(op.interval_join(*a, **k)) or seen[-1])
    query, sql = catalog.QUERIES["interval_join"]
    got = Counter(map(tuple, query(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    for name in ("orders", "part"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert got == Counter(con.execute(sql).fetchall()) and got
    assert seen[0].count() <= 400 * 3


def test_few_points_are_looked_up_by_many_tasks(spark):
    points = spark.range(200).select((F.col("id") % 60).alias("at"))
    ranges = spark.range(5000).select(F.col("id").alias("rid"), F.lit(0).cast("long").alias("low"), F.lit(1000).cast("long").alias("high"))
    out = op.interval_join(points, ranges, "at", "low", "high")
    assert out.count() == 1_000_000
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
