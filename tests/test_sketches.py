"""Stored quantile sketches and bitmaps add up to coarser groups."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from brisa.operators import sketches as sk


def data(spark, n=20_000):
    # Month m of group g; values skewed, some null; group 0 holds a third of all rows.
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, 0).otherwise(i % 7).alias("g"),
        (i % 12).alias("m"),
        F.when(i % 53 == 0, None).otherwise(F.pow((i * 7919) % 4999, F.lit(1.5))).alias("v"),
        F.when(i % 59 == 0, None).otherwise((i * i + 3 * i) % 70_000).alias("code"),
    )


def grouped(df, value):
    out = defaultdict(list)
    for r in df.collect():
        out[r["g"]].append(r[value])
    return out


def test_merged_sketches_are_exact_for_groups_that_fit(spark):
    df = data(spark, 3000)
    monthly = sk.quantile_sketches(df, ["g", "m"], "v")
    found = {r["g"]: r for r in sk.roll_up_quantiles(monthly, ["g"], [0.0, 0.25, 0.5, 0.95, 1.0], ["q0", "q25", "q50", "q95", "q100"]).collect()}
    for g, values in grouped(df, "v").items():
        values = sorted(v for v in values if v is not None)
        n = len(values)
        assert found[g]["rows"] == n and found[g]["mean"] == pytest.approx(sum(values) / n, rel=1e-12)
        for p, name in ((0.0, "q0"), (0.25, "q25"), (0.5, "q50"), (0.95, "q95"), (1.0, "q100")):
            assert found[g][name] == values[max(0, math.ceil(p * n) - 1)]


def test_merged_sketches_keep_the_stated_rank_error(spark):
    """Twelve monthly sketches of 128 values each for thousands of rows: at most a few of many quantiles may miss the 99 % bound."""
    df = data(spark)
    size = 128
    monthly = sk.quantile_sketches(df, ["g", "m"], "v", size)
    assert monthly.agg(F.max(F.length("sketch"))).first()[0] < 16 * size
    probs = [k / 20 for k in range(1, 20)]
    names = [f"q{k}" for k in range(1, 20)]
    found = {r["g"]: r for r in sk.roll_up_quantiles(monthly, ["g"], probs, names, size).collect()}
    missed = 0
    for g, values in grouped(df, "v").items():
        values = sorted(v for v in values if v is not None)
        for p, name in zip(probs, names, strict=True):
            below = sum(v < found[g][name] for v in values) / len(values)
            up_to = sum(v <= found[g][name] for v in values) / len(values)
            missed += not below - sk.rank_error(size) <= p <= up_to + sk.rank_error(size)
    assert missed <= 0.05 * 7 * len(probs)
    assert sk.rank_error(200) == pytest.approx(0.0133, abs=2e-4)


def test_merging_twice_is_merging_once(spark):
    df = data(spark, 4000)
    monthly = sk.quantile_sketches(df, ["g", "m"], "v")
    halves = sk.roll_up_quantiles(monthly, ["g", (F.col("m") < 6).alias("half")], keep=True)
    twice = {r["g"]: (r["rows"], r["p50"], r["p95"]) for r in sk.roll_up_quantiles(halves, ["g"]).collect()}
    assert twice == {r["g"]: (r["rows"], r["p50"], r["p95"]) for r in sk.roll_up_quantiles(monthly, ["g"]).collect()}


def test_groups_without_values(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 1, 5.0)], "g int, m int, v double")
    found = {r["g"]: (r["rows"], r["mean"], r["p50"], r["p95"]) for r in sk.roll_up_quantiles(sk.quantile_sketches(df, ["g", "m"], "v"), ["g"]).collect()}
    assert found == {1: (0, None, None, None), 2: (1, 5.0, 5.0, 5.0)}
    assert sk.roll_up_quantiles(sk.quantile_sketches(df.filter("g > 2"), ["g", "m"], "v"), ["g"]).count() == 0


def test_distinct_counts_add_up_exactly(spark):
    df = data(spark)
    bitmaps = sk.distinct_bitmaps(df, ["g", "m"], "code")
    assert bitmaps.agg(F.countDistinct("bucket")).first()[0] == 3  # codes to 70,000 lie in three stretches
    for keys in (["g"], ["m"], ["g", F.trunc(F.add_months(F.lit("2019-01-01").cast("date"), F.col("m").cast("int")), "quarter").alias("quarter")]):
        found = sorted(tuple(r) for r in sk.roll_up_distinct(bitmaps, keys, "codes").collect())
        assert found == sorted(tuple(r) for r in df.groupBy(*keys).agg(F.countDistinct("code")).collect())
