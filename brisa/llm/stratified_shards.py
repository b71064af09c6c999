"""Proportional stratified interleaving into shards of equal row count.

Rows of each source are shuffled by a seeded hash and ranked; a row's
fractional rank ``(rank + 1/2) / rows of the source`` spreads every source
evenly over (0, 1). Sorting all rows by fractional rank interleaves the sources
in proportion, and cutting the sequence into equal runs gives shards whose
counts differ by at most one and whose mixture follows the whole table's.

Ranks come from range partitions, not from a window over a source: a source
with a third of the rows is split over many partitions by its hash. Each pass
sorts narrow rows (ids, sizes, checksums - never texts) by sampled ranges,
writes them, counts rows per partition, and adds the running total of the
partitions before. The only single-partition step handles one row per
(partition, source) that occurs, which after sorting by source is at most
partitions + sources.

Edge cases: a null text has no bytes; a null source is a source of its own;
repeated rows are ranked in some fixed order; fewer rows than shards leave
later shards empty; empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm import store

_IN_PARTITION = (1 << 33) - 1


def _ranked(df: DataFrame, order: list[str], within: list[str], rank: str) -> DataFrame:
    """``df`` with the 0-based rank of each row by ``order`` inside each ``within`` group, and the group's size.

    ``within`` must be a prefix of ``order``.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = store.materialise(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))}),
        "ranked",
    )
    parts = placed.groupBy("part", *within).agg(F.count("*").alias("here"), F.min("at").alias("first"))
    group = Window.partitionBy(*within) if within else Window.partitionBy()
    before = parts.withColumns(
        {"before": F.sum("here").over(group.orderBy("part")) - F.col("here"), "group_rows": F.sum("here").over(group)}
    ).drop("here")
    joined = placed.alias("p").join(
        before.alias("b"),
        (F.col("p.part") == F.col("b.part")) & _all_equal(within),
    )
    return joined.select(
        *[F.col(f"p.{c}") for c in df.columns],
        (F.col("b.before") + F.col("p.at") - F.col("b.first")).alias(rank),
        F.col("b.group_rows").alias("group_rows"),
    )


def _all_equal(columns: list[str]):
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"p.{c}").eqNullSafe(F.col(f"b.{c}"))
    return out


def shard(
    docs: DataFrame,
    shards: int = 40,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, source, fraction, shard, slot``."""
    text = store.as_text(text_col)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "text_crc32"))
    ranked = _ranked(narrow, ["source", "draw", "doc_id", "text_crc32"], ["source"], "rank")
    spread = ranked.withColumn("fraction", (F.col("rank") + 0.5) / F.col("group_rows")).drop("rank", "group_rows")
    placed = _ranked(spread, ["fraction", "source", "draw", "doc_id", "text_crc32"], [], "position")
    # Shard s holds the positions from ceil(s * rows / shards) on.
    number = F.expr(f"(position * {shards}) div group_rows")
    first = F.expr(f"(((position * {shards}) div group_rows) * group_rows + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "size", "text_crc32", "source", "fraction", number.cast("int").alias("shard"), (F.col("position") - first).alias("slot")
    )
