"""Small helpers shared by the operators: written intermediates and input columns."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.session import scratch_path

# Rows per Arrow batch: a batch of very long texts must still fit a worker.
ARROW_ROWS = 512
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """What the Arrow-based operators count on: bounded batches, and this package on the executors.

    Spark ships the package to executors that were started without it (as
    ``--py-files`` does); a session ships it once.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="brisa-package-"), f"brisa-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage with a table that survives a lost executor, and makes
    values such as row ids and partition numbers fixed for every later pass.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs hold, after a written table has cut the lineage.

    Spark drops their shuffle files and broadcasts once the driver has collected
    the handles, and a driver that collects seldom keeps a heap many times its
    live data. For steps of many jobs.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def as_text(column: Column | str) -> Column:
    """Text with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), as_text(text_col).alias("text"))


BITMAP_BITS = 26


def bitmap(df: DataFrame, value: Column) -> np.ndarray:
    """One bit per slot of a 64-bit value (2 ** BITMAP_BITS slots, 8 MB, whatever the input's size).

    Built from partial bitmaps on the executors. A map task can so tell which
    rows surely do not matter without a join; rows that share a slot pass too.
    """
    slot = value.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)) + 1
    chunks = (
        df.groupBy(F.bitmap_bucket_number(slot).alias("chunk"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
        .toArrow()
    )
    out = np.zeros((1 << BITMAP_BITS) // 8, dtype=np.uint8)
    for chunk, bits in zip(chunks.column("chunk").to_pylist(), chunks.column("bits").to_pylist(), strict=True):
        at = (chunk - 1) * len(bits)
        out[at : at + len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the slots of 64-bit values are set."""
    slot = (values.astype(np.uint64) & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
