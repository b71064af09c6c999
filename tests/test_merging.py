"""A merged table equals the dedup of everything, and only touched partitions are read and replaced."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from brisa.operators import dedup_latest
from brisa.sources import merging

SCHEMA = "key string, month date, seen int, payload string, n int"
KEYS, BY = ["key", "month"], ["month"]


def order():
    return [F.col("seen").desc_nulls_last()]


def log(seed, months, n=120):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["a", "b", "c", None]), rng.choice(months), rng.choice([None, 1, 2, 3, 4]), rng.choice(["p", "q", None]), rng.randint(1, 3))
        for _ in range(n)
    ]
    return rows + rows[:5]  # repeated rows


def month(k):
    return dt.date(2020, k, 1)


def files_of(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}


def rows_of(df):
    return sorted(map(tuple, df.select("key", "month", "seen", "payload", "n").collect()), key=str)


@pytest.mark.parametrize("listed", [1_000, 1])
def test_batches_in_any_order_equal_the_dedup_of_everything(spark, tmp_dir, monkeypatch, listed):
    monkeypatch.setattr(merging, "LISTED", listed)
    batches = [log(1, [month(1), month(2)]), log(2, [month(2), None]), log(3, [month(1)], 30), log(4, [None, month(5), month(2)])]
    everything = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    want = rows_of(dedup_latest(everything, KEYS, order(), ["payload", "n"]))
    for name, turn in (("there", [0, 1, 2, 3]), ("back", [3, 2, 1, 0]), ("twice", [2, 0, 2, 1, 3, 0])):
        out = f"{tmp_dir}/{name}"
        for i in turn:
            merging.merge_latest(spark.createDataFrame(batches[i], SCHEMA), out, KEYS, order(), BY, ["payload", "n"])
        assert rows_of(spark.read.schema(SCHEMA).parquet(out)) == want


def test_only_touched_partitions_are_replaced(spark, tmp_dir):
    out = f"{tmp_dir}/t"
    merging.merge_latest(spark.createDataFrame(log(1, [month(k) for k in range(1, 7)]), SCHEMA), out, KEYS, order(), BY)
    before = files_of(out)
    touched = merging.merge_latest(spark.createDataFrame(log(2, [month(3), month(9)], 10), SCHEMA), out, KEYS, order(), BY)
    assert {r["month"] for r in touched.collect()} == {month(3), month(9)}
    after = files_of(out)
    assert {f: t for f, t in before.items() if "2020-03-01" not in f} == {f: t for f, t in after.items() if "2020-03-01" not in f and "2020-09-01" not in f}
    assert not {f for f in before if "2020-03-01" in f} & set(after)


def test_other_partitions_are_not_read(spark, tmp_dir):
    out = f"{tmp_dir}/t"
    merging.merge_latest(spark.createDataFrame(log(1, [month(k) for k in range(1, 7)]), SCHEMA), out, KEYS, order(), BY)
    for f in glob.glob(f"{out}/month=2020-01-01/*.parquet"):
        with open(f, "wb") as broken:  # whoever opens it fails
            broken.write(b"no parquet")
    for f in glob.glob(f"{out}/month=2020-01-01/.*.crc"):
        os.remove(f)
    touched = spark.createDataFrame([(month(2),), (month(3),)], "month date")
    part = merging.landed_part(spark.read.schema(SCHEMA).parquet(out), touched, BY)
    assert {r["month"] for r in part.select("month").distinct().collect()} == {month(2), month(3)}


def test_empty_batches_and_wrong_keys(spark, tmp_dir):
    out = f"{tmp_dir}/t"
    none = spark.createDataFrame([], SCHEMA)
    assert merging.merge_latest(none, out, KEYS, order(), BY).isEmpty()
    merging.merge_latest(spark.createDataFrame(log(1, [month(1)]), SCHEMA), out, KEYS, order(), BY)
    before = files_of(out)
    assert merging.merge_latest(none, out, KEYS, order(), BY).isEmpty()
    assert files_of(out) == before
    with pytest.raises(ValueError, match="no keys"):
        merging.merge_latest(none, out, ["key"], order(), BY)


def test_hot_key_of_a_batch_is_reduced_before_the_merge(spark, tmp_dir):
    rows = [("hot", month(1), i % 50, "p", i) for i in range(3_000)] + [("x", month(1), 1, "p", 1)]
    out = f"{tmp_dir}/t"
    merging.merge_latest(spark.createDataFrame(rows, SCHEMA).repartition(6), out, KEYS, order(), BY)
    assert rows_of(spark.read.schema(SCHEMA).parquet(out)) == [("hot", month(1), 49, "p", 49), ("x", month(1), 1, "p", 1)]
