"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Each unit vector is projected on ``projections`` random directions. On one
direction two vectors collide when the second lies in the window of half width
``window`` centred on the first. For vectors at the threshold angle the number
of collisions is binomial, which fixes the least count that a linked pair
reaches with probability ``recall``; pairs that reach it are verified by their
cosine in double precision.

Comparing every pair would be quadratic, so the first directions also cut the
space into tiles: a table's tiles are the cells of ``depth`` directions, split
at 0, and a vector whose projection lies within ``margin`` of a split belongs
to both sides. The depth follows from the number of vectors (about ``per_tile``
fall into one), and the number of tables from the probability, at the threshold
angle, that a pair shares a tile in one of them. Inside a tile the projections
are sorted and windows counted by numpy. A pair that meets in several tiles is
counted in the first only.

Tiles with more than ``block`` members - a large group of near copies - are cut
into blocks, and every pair of blocks is a task of its own, so no task holds an
unbounded group. Tasks emit link counts per vector and a spanning forest of the
links they found, never the links themselves.

Vectors with equal components are one node that counts for its copies, so a
large group of exact copies costs one node.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different dimension do not link; rows
that repeat an id are separate vectors of that id; empty input gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm import store
from brisa.llm.components import components


def _phi(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def collision_rate(cosine: float, window: float) -> float:
    """Probability that two unit vectors at this cosine collide on one direction."""
    spread = math.sqrt(max(2 * (1 - cosine), 1e-12))
    return 2 * _phi(window / spread) - 1


def least_collisions(cosine: float, window: float, projections: int, recall: float) -> int:
    """The largest count that a pair at the threshold reaches with probability ``recall``."""
    p, tail = collision_rate(cosine, window), 0.0
    for k in range(projections, -1, -1):
        tail += math.comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if tail >= recall:
            return k
    return 0


def shared_side(cosine: float, margin: float) -> float:
    """Probability that two vectors at this cosine share a side of one split (one of x < margin, x > -margin holds for both)."""
    x = np.linspace(-8, 8, 4001)
    density = np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    rest = math.sqrt(1 - cosine * cosine)
    # Apart: one below -margin and the other above margin.
    above = np.array([1 - _phi((margin - cosine * v) / rest) for v in x])
    apart = 2 * float(np.sum(density[x < -margin] * above[x < -margin]) * (x[1] - x[0]))
    return 1 - apart


def tables_needed(share: float, depth: int, recall: float) -> int:
    together = share**depth
    return 1 if together >= 1 - 1e-9 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def directions(dim: int, n: int, seed: int) -> np.ndarray:
    """Random directions with independent normal components, scaled so projections of unit vectors have unit variance over directions."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def _usable(column: str) -> Column:
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(column).isNotNull() & (F.size(column) > 0) & fine & F.exists(column, lambda x: x != 0), F.lit(False))


def _cells(value: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and cell of every tile that each row of projections belongs to."""
    rows, cell = np.arange(len(value)), np.zeros(len(value), dtype=np.int64)
    for d in range(value.shape[1]):
        v = value[rows, d]
        low, high = v < margin, v > -margin
        rows, cell = (
            np.concatenate([rows[low], rows[high]]),
            np.concatenate([cell[low] * 2, cell[high] * 2 + 1]),
        )
    return rows, cell


def link(
    vectors: DataFrame,
    threshold: float = 0.9,
    projections: int = 32,
    window: float = 0.8,
    margin: float = 0.05,
    recall: float = 0.995,
    per_tile: int = 512,
    block: int = 2048,
    seed: int = 11,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    rows = store.materialise(
        vectors.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("v"),
        ).withColumn("v", F.when(_usable("v"), F.transform("v", lambda x: x + 0.0))),
        "vectors",
    )
    nodes = store.materialise(
        rows.filter("v is not null").groupBy("v").agg(F.min("row").alias("node"), F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")),
        "distinct_vectors",
    )
    found = _links(nodes, threshold, projections, window, margin, recall, per_tile, block, seed)
    links = found.filter("other is null").groupBy("node").agg(F.sum("n").alias("n_links"))
    label = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = (
        nodes.join(links, "node", "left")
        .join(label.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    answer = named.join(least, "component").select("v", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.join(answer, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _links(nodes, threshold, projections, window, margin, recall, per_tile, block, seed) -> DataFrame:
    """Rows ``node, other, n``: with ``other`` an edge, without it ``n`` more links of ``node``."""
    total = nodes.count()
    depth = max(0, math.ceil(math.log2(max(1, total) / per_tile)))
    share = shared_side(threshold, margin)
    tables = tables_needed(share, depth, recall)
    enough = least_collisions(threshold, window, projections, recall)

    def tile_values(v: np.ndarray, table: int) -> np.ndarray:
        return v @ directions(v.shape[1], depth, seed + 1000 + table)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].str.len()):
                v = np.stack(part["v"].to_numpy())
                unit = v / np.abs(v).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                for table in range(tables):
                    at, cell = _cells(tile_values(unit, table), margin)
                    yield pd.DataFrame({"node": part["node"].to_numpy()[at], "dim": dim, "place": table, "cell": cell})

    placed = store.materialise(nodes.select("node", "v").mapInPandas(place, "node long, dim int, place int, cell long"), "tiles")
    tile = ["dim", "place", "cell"]
    sizes = placed.groupBy(*tile).agg(F.count("*").alias("members")).filter("members > 1")
    cut = placed.join(sizes, tile).withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cut = cut.withColumn("mine", mine).withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("node", *tile, "mine", F.least("mine", "other_block").alias("b1"), F.greatest("mine", "other_block").alias("b2"))
    members = cut.join(nodes.select("node", "v", "copies"), "node")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(part["v"].to_numpy())
        unit = v / np.abs(v).max(axis=1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        node, copies, side = part["node"].to_numpy(), part["copies"].to_numpy(), part["mine"].to_numpy()
        a, b = _collided(unit @ directions(v.shape[1], projections, seed), window, enough)
        same = int(part["b1"].iloc[0]) == int(part["b2"].iloc[0])
        # Pairs inside a block belong to that block's own task.
        ok = (side[a] != side[b]) | same
        a, b = a[ok], b[ok]
        cosine = np.concatenate([np.einsum("ij,ij->i", unit[a[i : i + 50_000]], unit[b[i : i + 50_000]]) for i in range(0, len(a), 50_000)] or [np.zeros(0)])
        a, b = a[cosine >= threshold], b[cosine >= threshold]
        # Count a pair only in the first tile that it shares.
        table, cell = int(part["place"].iloc[0]), int(part["cell"].iloc[0])
        first = np.ones(len(a), dtype=bool)
        for t in range(table + 1):
            value = tile_values(unit, t)
            low = (value[a] < margin) & (value[b] < margin)
            high = (value[a] > -margin) & (value[b] > -margin)
            shares = (low | high).all(axis=1)
            if t < table:
                first &= ~shares
            else:
                least = np.zeros(len(a), dtype=np.int64)
                for d in range(depth):
                    least = least * 2 + ~low[:, d]
                first &= least == cell
        a, b = a[first], b[first]
        n = np.bincount(a, weights=copies[b], minlength=len(node)) + np.bincount(b, weights=copies[a], minlength=len(node))
        root = _forest(a, b, len(node))
        linked, moved = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(node)))
        return pd.DataFrame(
            {
                "node": np.concatenate([node[linked], node[moved]]),
                "other": pd.array([*[None] * len(linked), *node[root[moved]].tolist()], dtype="Int64"),
                "n": np.concatenate([n[linked].astype(np.int64), np.zeros(len(moved), dtype=np.int64)]),
            }
        )

    return store.materialise(
        members.groupBy(*tile, "b1", "b2").applyInPandas(compare, "node long, other long, n long"), "vector_links"
    )


def _collided(value: np.ndarray, window: float, enough: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose projections collide on at least ``enough`` directions.

    On each direction the rows are sorted once, and a row's window is a run of
    ranks. Rows are taken in slices so that the table of counts stays small;
    each pair ``a < b`` is counted once, by the window of ``a``.
    """
    n, m = value.shape
    order = np.argsort(value, axis=0, kind="stable")
    rank = np.empty((m, n), dtype=np.uint32 if n > 1 << 16 else np.uint16)
    low, width = np.empty_like(rank), np.empty_like(rank)
    for j in range(m):
        ranked = value[order[:, j], j]
        rank[j, order[:, j]] = np.arange(n)
        low[j] = first = np.searchsorted(ranked, value[:, j] - window, "left")
        width[j] = np.searchsorted(ranked, value[:, j] + window, "right") - first
    found_a, found_b = [], []
    step, most = max(1, (1 << 19) // max(1, n)), 3 * m // 4
    for at in range(0, n, step):
        rows = slice(at, min(n, at + step))
        # A rank is in the window if, counted from the window's begin (wrapping below 0), it is under its width.
        count = np.zeros((rows.stop - at, n - at), dtype=np.uint8 if most < 256 else np.uint16)
        for j in range(most):
            inside = (rank[j, None, at:] - low[j, rows, None]) < width[j, rows, None]
            count += inside.view(np.uint8)
        # The last directions only for pairs that can still reach the count.
        a, b = np.nonzero(count >= max(0, enough - (m - most)))
        later = b > a
        a, b = a[later], b[later]
        total = count[a, b].astype(np.int64)
        a, b = a + at, b + at
        for j in range(most, m):
            total += (rank[j, b] - low[j, a]) < width[j, a]
            can = total >= enough - (m - 1 - j)
            a, b, total = a[can], b[can], total[can]
        found_a.append(a)
        found_b.append(b)
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (np.zeros(0, int), np.zeros(0, int))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each row's component under the links ``a - b``."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            return root
        root = least
