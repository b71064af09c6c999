"""Connected components of an edge table by alternating large and small stars.

Each round joins every edge with its node's smallest neighbour and writes the
new, smaller edge table to the shared folder; the minimum is a map-side
combined aggregate, so a node with very many edges costs no single task its
neighbourhood. Rounds grow with the logarithm of the longest path; the last is
the one that leaves stars, which an aggregate over the nodes tells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm import store


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    # The row of a node's smallest neighbour keeps the node there; the other rows move their neighbour there.
    return down.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))


def _settled(edges: DataFrame) -> bool:
    """Whether distinct edges, each from a node to a smaller one, form stars: who leads to a node leads to one only, and nobody leads to it."""
    ends = [F.struct(F.col(c).alias("node"), F.lit(c == "a").alias("leads")) for c in ("a", "b")]
    ends = edges.select(F.explode(F.array(*ends)).alias("end"))
    nodes = ends.groupBy("end.node").agg(F.count_if(F.col("end.leads")).alias("up"), F.count("*").alias("all"))
    return nodes.agg(F.count_if((F.col("up") > 0) & (F.col("all") > 1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the component's smallest node) of every node in ``edges(a, b)``.

    Self edges are ignored; nodes without another edge get no row.
    """
    now = store.materialise(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    while True:
        now = store.materialise(_small(_large(now)).distinct(), "edges")
        store.release(now.sparkSession)
        if _settled(now):
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
