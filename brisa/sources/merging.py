"""Merging later rows into a landed table that holds one row per key (W1 over time).

``dedup_latest`` over the whole log reads the whole log again for every batch.
Where the partition columns are part of the key, rows of one key never lie in
two partitions, so only the partitions that the batch touches can change: they
are read, merged with the batch and replaced; all others stay as they are, file
by file.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import dedup_latest
from ..session import scratch_path
from . import files

# Partitions named in one pruning predicate; where a batch touches more, the whole table is read and joined.
LISTED = 1_000


def _landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def touched_partitions(batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The distinct partition values of ``batch``."""
    return batch.select(*partition_by).distinct()


def landed_part(landed: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``landed`` in the touched partitions.

    Up to ``LISTED`` values become a predicate on the partition columns, and
    other partitions' files are not opened; beyond that the rows are found by a
    join over all partitions.
    """
    values = touched.limit(LISTED + 1).collect()
    if len(values) > LISTED:
        same = reduce(lambda a, b: a & b, [landed[c].eqNullSafe(touched[c]) for c in partition_by])
        return landed.join(touched, same, "left_semi")
    hits = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in partition_by]) for row in values]
    return landed.filter(reduce(lambda a, b: a | b, hits, F.lit(False)))


def merge_latest(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column],
    partition_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Merge ``batch`` into the table at ``path``; return the partition values that were written.

    The table then equals ``dedup_latest(everything so far, keys, order,
    tie_break)``: the first row of a key under ``order`` wins, whichever batch
    it came with, so batches may come late, twice or in any order. The
    partition columns must be keys (``ValueError`` otherwise). A table that does
    not exist yet is created; an empty batch changes nothing. Null keys and null
    partition values are values like any other; an empty string as a partition
    value is written as null, as Spark does.

    The batch is reduced to one row per key first, so a key that repeats often
    in it costs one row in the merge. The merged partitions are written beside
    the table and then replace it partition by partition, so nothing that is
    being read is replaced, and a run that was cut off can be repeated.
    """
    missing = [c for c in partition_by if c not in keys]
    if missing:
        raise ValueError(f"partition columns that are no keys: {missing}; a key could lie in several partitions")
    spark = batch.sparkSession
    # Ties are broken in a fixed column order, as reading a partitioned table moves its partition columns to the end.
    inner = [c for c in batch.columns if c not in partition_by] + list(partition_by)
    if tie_break is None:
        simple = {f.name for f in batch.schema if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
        tie_break = [c for c in batch.columns if c in simple and c not in keys]
    batch = _written(dedup_latest(batch.select(*inner), keys, order, tie_break), "merge_batch")
    touched = _written(touched_partitions(batch, partition_by), "merge_touched")
    if touched.isEmpty():
        return touched
    merged, landed = batch, _landed(spark, path, batch.schema)
    if landed is not None:
        merged = dedup_latest(landed_part(landed, touched, partition_by).unionByName(batch), keys, order, tie_break)
        merged = _written(merged, "merge_rows")
    files.overwrite_partitions(merged.hint("rebalance", *[F.col(c) for c in partition_by]), path, partition_by)
    return touched
