"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. UTC so hour buckets and dates agree with the
# SQL oracle; AQE so joins and partition counts follow measured sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Quantile sketches per hub, month and event: more groups than the default of 128 a task must not fall back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None, shuffle_partitions: int | None = None, app: str = "brisa", extra: dict | None = None
) -> SparkSession:
    """A session with the settings every job relies on.

    Without ``master`` and ``shuffle_partitions`` the launcher's settings hold
    (``spark-submit``, the defaults file, ``cluster_conf``).
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read; it is
    an error there to leave it unset. Under a local master (tests, one machine)
    a private folder is created and set instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="brisa-ckpt-", dir=os.environ.get("BRISA_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def task_bytes(spark: SparkSession, size: str) -> Iterator[None]:
    """Adaptive execution merges small shuffle partitions up to ``size`` only, for what runs inside.

    For jobs whose tasks sort rows that take far more memory than in the
    shuffle: merged up to the usual size they would spill.
    """
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions start at input size / 256 MiB (at least 2x the cores);
    AQE then coalesces small ones and splits skewed ones at runtime, so a key
    holding a large share of the rows is spread over several tasks. Scan
    splits are 256 MiB so a task's working set stays well inside executor
    memory. For 100 TB this gives about 400,000 shuffle partitions.
    """
    partitions = max(2 * cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
