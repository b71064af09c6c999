"""Many key checks in one shuffle give the failures of the single checks."""

import random

import pytest
from pyspark.sql import functions as F

from brisa.operators import quality as q
from brisa.operators.key_checks import ForeignKey, UniqueKey, key_checks

KEYS = ["relation", "column_name", "check_name", "severity", "failures", "status"]


def result(df):
    return sorted(tuple(r[k] for k in KEYS) for r in df.collect())


def frames(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(-40, 40)]), rng.choice([None, "a", "b", ""]), rng.choice([0.0, -0.0, 1.5, None]), rng.choice([None, *range(100_000)])) for _ in range(900)]
    child = spark.createDataFrame(rows, "k int, s string, x double, wide long")
    clean = spark.range(-70_000, 70_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t"), (F.col("id") % 700).alias("g"))
    return child, clean


def test_same_failures_as_the_single_checks(spark):
    child, clean = frames(spark)
    few = clean.filter("k between -20 and 30 or k > 60000")
    uniques = [("child", child, c) for c in (["k"], ["k", "s"], ["s", "k"], ["x"], ["x", "s"], ["wide"])] + [("clean", clean, ["k"]), ("clean", clean, ["k", "t"]), ("clean", clean, ["g"])]
    foreign = [("child", child, "k", few, "k"), ("child", child, "wide", clean, "k"), ("clean", clean, "g", few, "k"), ("child", child, "s", clean, "t"), ("clean", clean, "k", clean, "t"), ("clean", clean, "k", child.filter("k > 1000"), "k")]
    rules = [UniqueKey(n, d, c, severity="warn") for n, d, c in uniques] + [ForeignKey(n, d, c, p, pc) for n, d, c, p, pc in foreign]
    single = [q.unique(d, n, c, severity="warn") for n, d, c in uniques] + [q.relationships(d, n, c, p, pc) for n, d, c, p, pc in foreign]
    expected = result(q.union_checks(single))
    assert result(key_checks(rules)) == expected
    assert {r[4] == 0 for r in expected} == {True, False}


@pytest.mark.parametrize("start", [0, -70_000])
def test_dense_keys(spark, start):
    child, clean = frames(spark)
    clean = clean.filter(F.col("k") >= start)
    holes = clean.filter("k % 40000 != 7")
    doubled = clean.unionAll(clean.filter("k in (5, 40000)"))
    rules = [UniqueKey("a", clean, ["k"], dense=True), UniqueKey("b", doubled, ["k"], dense=True), UniqueKey("c", child, ["k"], dense=True)]
    rules += [ForeignKey("d", doubled, "k", clean, "k", dense=True), ForeignKey("e", doubled, "k", holes, "k", dense=True), ForeignKey("f", child, "k", holes, "k", dense=True)]
    single = [q.unique(r.df, r.relation, r.columns) for r in rules[:3]] + [q.relationships(r.df, r.relation, r.column, r.parent, r.parent_column) for r in rules[3:]]
    assert result(key_checks(rules)) == result(q.union_checks(single))
    with pytest.raises(TypeError):
        key_checks([UniqueKey("g", clean, ["t"], dense=True)]).collect()


def test_empty_relations(spark):
    _, clean = frames(spark)
    none = clean.filter("k is null")
    rules = [UniqueKey("a", none, ["k"]), UniqueKey("b", none, ["k"], dense=True), ForeignKey("c", none, "k", clean, "k"), ForeignKey("d", clean, "g", none, "k"), ForeignKey("e", clean, "g", none, "k", dense=True)]
    assert [r[4] for r in result(key_checks(rules))] == [0, 0, 0, 140_000, 140_000]


def shuffled_bytes(df):
    """Bytes that the exchanges of a finished query wrote."""
    rows = df.collect()
    total, seen = 0, [df._jdf.queryExecution().executedPlan()]
    while seen:
        node = seen.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            seen.append(node.finalPhysicalPlan())
        elif name.endswith("QueryStageExec"):
            seen.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                total += node.metrics().apply("dataSize").value()
            children = node.children()
            seen += [children.apply(i) for i in range(children.size())]
    return total, rows


def test_less_is_shuffled(spark):
    long_keys = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), (F.col("id") % 3000).alias("part"), F.col("id").alias("number"))
    parent = spark.range(3000).select(F.col("id").alias("part"))
    single, _ = shuffled_bytes(q.unique(long_keys, "r", ["id"]))
    hashed, _ = shuffled_bytes(key_checks([UniqueKey("r", long_keys, ["id"])]))
    dense, _ = shuffled_bytes(key_checks([UniqueKey("r", long_keys, ["number"], dense=True), ForeignKey("r", long_keys, "part", parent, "part", dense=True)]))
    assert hashed < 0.65 * single, (hashed, single)
    assert dense < 0.05 * single, (dense, single)
