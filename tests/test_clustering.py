"""Z-order layout: filters on any key alone skip most row groups; the rows stay the same."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from brisa.sources import clustering, files


def rows(spark, n=120_000):
    i = F.col("id")
    return spark.range(n).select(
        (F.xxhash64(i) % 5000).alias("a"),
        F.concat(F.lit("k"), F.lpad(F.pmod(F.xxhash64(i, F.lit(1)), F.lit(3000)).cast("string"), 5, "0")).alias("b"),
        F.date_add(F.lit(dt.date(2019, 1, 1)), F.pmod(F.xxhash64(i, F.lit(2)), F.lit(1000)).cast("int")).alias("c"),
        i.alias("id"),
    )


def touched(path, column, low, high):
    """Share of the row groups whose statistics admit the range."""
    hit = total = 0
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(k).path for k in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(names.index(column)).statistics
            total += 1
            hit += s.min <= high and s.max >= low
    return hit / total, total


def test_every_key_prunes(spark, tmp_dir):
    df = rows(spark)
    shares = {}
    for way in (True, False):
        path = f"{tmp_dir}/{way}"
        before = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert files.write_layout(df, path, None, ["a", "b", "c"], interleave=way, row_group_bytes=1 << 15) == 120_000
        spark.conf.set("spark.sql.adaptive.enabled", before)
        ranges = {"a": (-200, 200), "b": ("k00300", "k00500"), "c": (dt.date(2020, 1, 1), dt.date(2020, 2, 20))}
        shares[way] = {c: touched(path, c, *r) for c, r in ranges.items()}
        back = spark.read.parquet(path)
        assert back.columns == df.columns and back.exceptAll(df).count() == 0 and back.count() == 120_000
    assert all(total >= 24 and share < 0.5 for share, total in shares[True].values()), shares
    assert max(shares[False]["b"][0], shares[False]["c"][0]) > 0.9, shares


def test_keys_order_like_ranks(spark):
    df = rows(spark, 4000).withColumn("b", F.when(F.col("id") % 9 == 0, None).otherwise(F.col("b")))
    for columns in (["a"], ["a", "b"], ["a", "b", "c", "id"]):
        cuts = clustering.boundaries(df, columns, 3)
        assert all(len(v) <= 7 and v == sorted(set(v)) for v in cuts.values())
        for r in clustering.with_key(df, columns, "z", 3).select("z", *columns).limit(200).collect():
            z = 0
            values = [(r[c] - dt.date(1970, 1, 1)).days if c == "c" else r[c] for c in columns]
            ranks = [0 if v is None else sum(x <= v for x in cuts[c]) for c, v in zip(columns, values, strict=True)]
            for bit in (2, 1, 0):
                for rank in ranks:
                    z = z << 1 | rank >> bit & 1
            assert r["z"] == z
    with pytest.raises(ValueError):
        clustering.with_key(df, ["a", "b", "c", "id", "id"], "z")


def test_layout_by_month_of_an_empty_and_a_constant_table(spark, tmp_dir):
    df = rows(spark, 100).withColumns({"a": F.lit(1), "b": F.lit(None).cast("string")})
    assert files.write_layout(df, f"{tmp_dir}/x", "c", ["a", "b"], interleave=True) == 100
    assert spark.read.parquet(f"{tmp_dir}/x").count() == 100
    assert files.write_layout(df.filter("id < 0"), f"{tmp_dir}/y", None, ["a", "b"], interleave=True) == 0
