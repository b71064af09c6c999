"""Exact n-gram Jaccard join with size-banded tiles and bitmap signatures.

A document's set is its distinct word shingles as 64-bit hashes. Two documents
link when the Jaccard similarity of their sets reaches ``percent``.

1. One pass over the texts writes, per document, the set's size, a 64-bit key
   of the whole set, and a 512-bit signature (every shingle sets one bit); and
   counts, per task, how often hash slots occur. Documents with equal keys are
   one node from here on.
2. Shingles are ordered rare first by a fixed-size table of slot counts (ties
   by hash). Any fixed order is exact, so the table changes only speed. Two
   sets that link share a shingle among the first ``n - ceil(t n) + 1`` of each
   in this order: those are the tokens a node is filed under.
3. Nodes of one token and neighbouring size bands (factor 1 / t) form a tile;
   others cannot link. Tokens met by one node alone vanish here. A row also
   holds how far down its node's order the token stands: of the first token that
   two sets share, both places bound the overlap, so a pair whose places at a
   token forbid the link is left to its other tokens.
4. Each node is compared with a few nodes of its tile; in a group of up to nine
   these are all pairs. A pair goes on only if bands and places allow the link,
   the sizes do and the signatures' bit counts, which bound the
   overlap from above, do; sets too large for 512 bits have a second signature
   of one to two bits a shingle. Then the sorted hash arrays are intersected.
5. Links found so far give components. Only larger groups that still hold
   several components go on: first their nodes are compared with the best-linked
   nodes of the tile, then nodes outside one component, under the same bounds,
   with the tile's nodes of other components. Every pair of linked nodes is thus
   either compared or already connected.

So groups of near copies cost a few comparisons per node, not all pairs;
no tile is ever collected in one place except by sorting (spilling) or joining
(which splits skewed keys); tokens that are frequent by the slot table go
through aggregates with map-side combine and a join instead of the sort.
Wrong answers would need two different 64-bit hashes to collide.

Edge cases: null and empty texts, and texts of white space, have empty sets and
link with nothing; with fewer words than a shingle the whole sequence is one;
rows that repeat are nodes with equal sets; empty input gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm import store
from brisa.llm.components import components

WORDS = 8  # 64-bit words of a signature
SLOT_BITS = 24
SCHEMA = "doc_id long, n int, key long, " + ", ".join(f"b{i} long" for i in range(WORDS)) + ", wide binary, slot int, seen long"
WIDE_FROM = 64 * WORDS  # sets of more shingles have a wide signature
WIDE_MOST = 1 << 16
NEIGHBOURS = 8
DRAWN = 2  # nodes that a frequent token draws; who links with neither meets the best-linked nodes next
HOT_LEVEL = 40  # about 2 ** (40 / 4) documents
STEPS = 32  # of a token's standing in its node's order; a place is band * STEPS + step
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of one text."""
    import xxhash

    # bytes.lower and bytes.split know ASCII only, as the definition does.
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    if len(h) < words:
        short = np.uint64(len(h))
        for x in h:
            short = _mix(np.array([short * _MULTIPLIER ^ x], dtype=np.uint64))[0]
        return np.array([short], dtype=np.uint64)
    n = len(h) - words + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(words):
        out = _mix(out * _MULTIPLIER + h[i : i + n])
    return np.unique(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _key(found: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def _signature(found: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * WORDS, dtype=np.uint8)
    bits[(found >> np.uint64(40)).astype(np.int64) % (64 * WORDS)] = 1
    return np.packbits(bits).view("<i8")


def _wide(found: np.ndarray) -> bytes | None:
    """Signature of one to two bits a shingle (a power of two, at most WIDE_MOST) of a large set.

    Even at one bit a shingle an unrelated set of equal size lacks bits for 23 %
    of the shingles, which bounds the similarity by 0.62.
    """
    if len(found) <= WIDE_FROM:
        return None
    size = min(WIDE_MOST, 1 << (len(found) - 1).bit_length())
    bits = np.zeros(size, dtype=np.uint8)
    bits[(found >> np.uint64(40)).astype(np.int64) % size] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _overlap_bound(nx: int, ny: int, x: bytes, y: bytes) -> int:
    """Most shingles that two sets can share: a bit that one has and the other lacks is a shingle the other lacks."""
    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(p) != len(q):  # fold the longer: its places modulo half its size
        if len(p) > len(q):
            p = p[: len(p) // 2] | p[len(p) // 2 :]
        else:
            q = q[: len(q) // 2] | q[len(q) // 2 :]
    return min(nx - int(np.bitwise_count(p & ~q).sum()), ny - int(np.bitwise_count(q & ~p).sum()))


def _slots(found: np.ndarray) -> np.ndarray:
    return (found & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _describe(docs: DataFrame, words: int) -> DataFrame:
    """Pass 1: a row per document, and a row per slot that a task met often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, dtype=np.uint16)
        met: set[int] = set()
        total = 0
        for batch in batches:
            n, keys, bits, wide = [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), words)
                n.append(len(found))
                keys.append(_key(found) if len(found) else None)
                bits.append(_signature(found))
                wide.append(_wide(found))
                if len(found) and keys[-1] not in met:
                    met.add(keys[-1])
                    total += len(found)
                    at = _slots(found)
                    counts[at] += counts[at] < 65535
            table = np.array(bits, dtype=np.int64).reshape(len(n), WORDS)
            none = pa.nulls(len(n), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(keys, pa.int64())]
                + [pa.array(table[:, i]) for i in range(WORDS)]
                + [pa.array(wide, pa.binary()), none, pa.nulls(len(n), pa.int64())],
                names=_columns(),
            )
        # What chance puts into a slot stays below this.
        often = np.flatnonzero(counts >= 4 + 4 * math.ceil(total / counts.size))
        if len(often):
            nothing = pa.nulls(len(often), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [nothing, pa.nulls(len(often), pa.int32()), nothing]
                + [nothing] * WORDS
                + [pa.nulls(len(often), pa.binary()), pa.array(often.astype(np.int32)), pa.array(counts[often].astype(np.int64))],
                names=_columns(),
            )

    return docs.mapInArrow(run, SCHEMA)


def _columns() -> list[str]:
    return [c.strip().split(" ")[0] for c in SCHEMA.split(",")]


def _levels(described: DataFrame) -> np.ndarray:
    """Quarter-octave count of each slot; one byte per slot, whatever the input's size."""
    often = described.filter("slot is not null").groupBy("slot").agg(F.sum("seen").alias("seen")).toArrow()
    levels = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
    if often.num_rows:
        seen = often.column("seen").to_numpy().astype(np.float64)
        levels[often.column("slot").to_numpy()] = np.minimum(255, 1 + np.floor(4 * np.log2(seen)))
    return levels


def _filed(docs: DataFrame, levels, words: int, percent: int, hot: bool) -> DataFrame:
    """Pass 2: ``token, place, key`` of every token a node is filed under, frequent tokens or the others."""
    step = math.log(100 / percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        for batch in batches:
            token, key, size, steps = [], [], [], []
            met: set[int] = set()
            for text in batch.column(1):
                found = shingles(text.as_py(), words)
                n = len(found)
                if not n:
                    continue
                k = _key(found)
                if k in met:
                    continue
                met.add(k)
                level = table[_slots(found)]
                take = n - (n * percent + 99) // 100 + 1
                order = np.argsort(level, kind="stable")[:take]
                at = np.flatnonzero((level[order] >= HOT_LEVEL) == hot)
                if len(at):
                    token.append(found[order[at]])
                    key.append(k)
                    size.append((len(at), n))
                    # Rounded down, which bounds less.
                    steps.append(np.minimum(STEPS - 1, at * (100 * STEPS) // (n * max(1, 100 - percent))))
            if token:
                flat = np.concatenate(token)
                many = np.array([s for s, _ in size])
                band = np.floor(np.log([n for _, n in size]) / step + 1e-9).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((flat >> np.uint64(20)).astype(np.uint32).view(np.int32)),
                        pa.array((np.repeat(band, many) * STEPS + np.concatenate(steps)).astype(np.int32)),
                        pa.array(np.repeat(np.array(key, dtype=np.int64), many)),
                    ],
                    names=["token", "place", "key"],
                )

    return docs.mapInArrow(run, "token int, place int, key long")


def _band(place: Column | str) -> Column:
    return F.floor((F.col(place) if isinstance(place, str) else place) / STEPS).cast("int")


def _places_allow(x: Column, y: Column, percent: int) -> Column:
    """Whether two nodes whose first common token has these places may link.

    With ``t`` as the similarity, a link needs an overlap of ``t (nx + ny) / (1 + t)``.
    Of a set whose first common token stands behind a share ``f`` of it at most
    ``(1 - f) n`` are common: ``ny / nx <= (1 - f) (1 + t) / t - 1``, and likewise
    for the other, so the product of both right sides must reach 1.
    """

    def most(place: Column) -> Column:
        share = F.pmod(place, F.lit(STEPS)) * ((100 - percent) / (100 * STEPS))
        return (1 - share) * ((100 + percent) / percent) - 1

    near = F.abs(_band(x) - _band(y)) <= 1
    return near & (most(x) * most(y) >= 1 - 1e-9)


def _tiles(docs: DataFrame, levels, words: int, percent: int) -> DataFrame:
    """``token, place, key, others, many``: rows of tokens that several nodes share.

    ``others`` are nodes to compare with first: those that bands and places
    allow among the ``NEIGHBOURS`` before it in the token's order by place, which
    in a small group is everyone before it; ``many`` marks rows with more nodes
    within reach, of which other pairs remain. Rows whose place allows nobody
    within reach go. Frequent tokens are not sorted in one place: their nodes are
    compared with as many nodes drawn by hash from the tile, found by aggregates.
    """
    cold = _filed(docs, levels, words, percent, hot=False)
    token = Window.partitionBy("token")
    before = [F.lag(F.struct("place", "key"), i).over(token.orderBy("place", "key")) for i in range(1, NEIGHBOURS + 1)]
    # Bands that differ by one are less than 2 * STEPS places apart; those in between in this order are within reach too.
    reach = token.orderBy("place").rangeBetween(1 - 2 * STEPS, 2 * STEPS - 1)
    step = F.pmod("place", F.lit(STEPS))
    allowed = F.filter("before", lambda o: _places_allow(o["place"], F.col("place"), percent))
    cold = (
        cold.withColumns({"lo": F.min("key").over(token), "hi": F.max("key").over(token)})
        .filter("lo <> hi")
        .withColumns({"before": F.array_compact(F.array(*before)), "rows": F.count("*").over(reach), "least": F.min(step).over(reach)})
        .filter((F.col("rows") > 1) & _places_allow(F.col("place"), _band("place") * STEPS + F.col("least"), percent))
        .select("token", "place", "key", allowed["key"].alias("others"), (F.col("rows") > NEIGHBOURS + 1).alias("many"))
    )
    if not (levels.value >= HOT_LEVEL).any():
        return store.materialise(cold, "tiles")
    hot = store.materialise(_filed(docs, levels, words, percent, hot=True).distinct(), "hot_tiles")
    shared = hot.groupBy("token").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo <> hi").select("token")
    names = [f"d{i}" for i in range(DRAWN)]
    hot = hot.withColumn("band", _band("place"))
    drawn = hot.groupBy("token", "band").agg(*[F.min(F.struct(F.xxhash64(F.lit(i), "key"), "key")).alias(d) for i, d in enumerate(names)])
    # A tile reaches one band down, so its drawn nodes may be the lower band's.
    reach = drawn.unionByName(drawn.withColumn("band", F.col("band") + 1))
    reach = reach.groupBy("token", "band").agg(F.array(*[F.min(d)["key"] for d in names]).alias("others"))
    hot = hot.join(shared, "token", "left_semi").join(reach, ["token", "band"])
    return store.materialise(cold.unionByName(hot.select("token", "place", "key", "others", F.lit(True).alias("many"))), "tiles")


def _may_link(x: str, y: str, percent: int) -> Column:
    """Sizes and signatures allow the link: each bit that one has and the other lacks stands for a shingle it lacks."""

    def lacks(p: str, q: str) -> Column:
        out = F.lit(0)
        for i in range(WORDS):
            out = out + F.bit_count(F.col(f"{p}.b{i}").bitwiseAND(F.bitwise_not(F.col(f"{q}.b{i}"))))
        return out

    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    enough = percent * (nx + ny)  # (100 + percent) * overlap must reach this
    sizes = (100 + percent) * F.least(nx, ny) >= enough
    return sizes & ((100 + percent) * F.least(nx - lacks(x, y), ny - lacks(y, x)) >= enough)


def _bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the pairs that the bounds let through."""
    return (
        pairs.alias("p")
        .join(nodes.alias("x"), F.col("p.a") == F.col("x.key"))
        .join(nodes.alias("y"), (F.col("p.b") == F.col("y.key")) & _may_link("x", "y", percent))
        .select("p.a", "p.b")
    )


def _bounded_wide(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the wide signatures let through too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nx, ny = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(3), batch.column(5), strict=True)):
                x, y = x.as_py(), y.as_py()
                bound = min(nx[i], ny[i]) if x is None or y is None else _overlap_bound(nx[i], ny[i], x, y)
                keep.append((100 + percent) * bound >= percent * (nx[i] + ny[i]))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = nodes.select(F.col("key").alias("a"), F.col("n").alias("nx"), F.col("wide").alias("wx"))
    y = nodes.select(F.col("key").alias("b"), F.col("n").alias("ny"), F.col("wide").alias("wy"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "nx", "wx", "ny", "wy").mapInArrow(run, "a long, b long")


def _place(doc_id: Column) -> Column:
    """Where an id is in the bitmap: its low bits, mixed with those above."""
    return doc_id.bitwiseXOR(F.shiftright(doc_id, store.BITMAP_BITS))


def _sets(docs: DataFrame, nodes: DataFrame, keys: DataFrame, words: int) -> DataFrame:
    """``key, found`` (the packed sorted hashes) of the given nodes, from one document of each.

    The texts are not shuffled: a bitmap of fixed size over ids tells each task
    which of its documents may stand for a wanted node, and only their shingles
    are computed. A few others pass by chance, and documents that repeat an id;
    their rows join with nothing or give the same links again.
    """
    wanted = nodes.select("key", "doc_id").join(keys, "key", "left_semi")
    bits = docs.sparkSession.sparkContext.broadcast(store.bitmap(wanted, _place(F.coalesce("doc_id", F.lit(-1)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            key, found = [], []
            ids = batch.column(0).fill_null(-1).to_numpy()
            for i in np.flatnonzero(store.in_bitmap(table, ids ^ (ids >> store.BITMAP_BITS))).tolist():
                have = shingles(batch.column(1)[i].as_py(), words)
                if len(have):
                    key.append(_key(have))
                    found.append(have.tobytes())
            if key:
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(found, pa.binary())], names=["key", "found"])

    sets = store.materialise(docs.mapInArrow(run, "key long, found binary"), "sets")
    bits.destroy()
    return sets


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the similarity, by exact intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.searchsorted(p, q)
                both = int((p[np.minimum(at, len(p) - 1)] == q).sum())
                keep.append((100 + percent) * both >= percent * (len(p) + len(q)))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("key").alias("a"), F.col("found").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("key").alias("b"), F.col("found").alias("y")), "b")
    return with_b.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _labelled(tiles: DataFrame, label: DataFrame) -> DataFrame:
    """``token, place, key, component, lo`` of the rows of larger groups that still hold several components; ``lo`` is one of them."""
    tiles = tiles.filter("many")
    named = tiles.join(label, tiles["key"] == label["node"], "left").select(
        "token", "place", "key", F.coalesce("component", "key").alias("component")
    )
    mixed = named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    return named.join(mixed.select("token", "lo"), "token")


def _to_hubs(tiles: DataFrame, edges: DataFrame, label: DataFrame) -> DataFrame:
    """``a, b``: nodes of a tile with its best-linked nodes so far that are in other components.

    Near copies of one text link with that text rather than with each other, so
    the text has many links by now, and one comparison with it joins a copy that
    resembles none of the nodes that were drawn. ``NEIGHBOURS`` hash classes of a
    tile each name their best-linked node; found by aggregates.
    """
    rows = _labelled(tiles, label).select("token", _band("place").alias("band"), "key", "component")
    degree = edges.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").count()
    names = [f"h{i}" for i in range(NEIGHBOURS)]
    own = F.pmod(F.xxhash64(F.lit("hub"), "key"), F.lit(NEIGHBOURS))
    linked = rows.join(degree, "key").withColumn("hub", F.struct("count", "key", "component"))
    best = linked.groupBy("token", "band").agg(*[F.max(F.when(own == i, F.col("hub"))).alias(h) for i, h in enumerate(names)])
    reach = best.withColumn("band", F.explode(F.array(*[F.col("band") + d for d in (-1, 0, 1)])))
    reach = reach.groupBy("token", "band").agg(F.array_compact(F.array(*[F.max(h) for h in names])).alias("hubs"))
    found = rows.join(reach, ["token", "band"]).select("key", "component", F.explode("hubs").alias("hub")).filter("component <> hub.component")
    return found.select(F.least("key", "hub.key").alias("a"), F.greatest("key", "hub.key").alias("b")).distinct()


def _crossing(tiles: DataFrame, nodes: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Pairs of one tile that are in different components so far and that places and the bounds let through."""
    open_rows = store.materialise(_labelled(tiles, label).join(nodes.drop("doc_id", "wide"), "key"), "open_tiles")
    open_rows = open_rows.withColumn("band", _band("place"))
    # One component of each token (the smallest) needs no comparison inside; the others look at everything else.
    outside = open_rows.filter("component <> lo").withColumn("probe", F.explode(F.array(*[F.col("band") + d for d in (-1, 0, 1)])))
    x, y = outside.alias("x"), open_rows.alias("y")
    meet = (
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.probe") == F.col("y.band"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("y.lo")) | (F.col("x.key") < F.col("y.key")))
        & _places_allow(F.col("x.place"), F.col("y.place"), percent)
        & _may_link("x", "y", percent)
    )
    return x.join(y, meet).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()


def link(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    spark = docs.sparkSession
    read = store.documents(docs, id_col, text_col)
    described = store.materialise(_describe(read, words), "described")
    rows = described.filter("slot is null").drop("slot", "seen")
    levels = spark.sparkContext.broadcast(_levels(described))
    bits = [F.first(f"b{i}").alias(f"b{i}") for i in range(WORDS)]
    nodes = store.materialise(
        rows.filter("n > 0").groupBy("key", "n").agg(F.min("doc_id").alias("doc_id"), *bits, F.first("wide").alias("wide")), "nodes"
    )
    tiles = _tiles(read, levels, words, percent)
    levels.destroy()  # the tiles are written
    store.release(spark)
    pairs = tiles.select("key", F.explode("others").alias("other")).filter("key <> other")
    pairs = pairs.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b"))
    pairs = store.materialise(_bounded(pairs.distinct(), nodes, percent), "first_pairs")
    near = store.materialise(_bounded_wide(pairs, nodes, percent), "first_near")
    edges = store.materialise(_verified(near, _sets(read, nodes, _ends(near), words), percent), "first_links")
    store.release(spark)
    label = components(edges)
    hubs = store.materialise(_bounded(_to_hubs(tiles, edges, label).join(pairs, ["a", "b"], "left_anti"), nodes, percent), "hub_pairs")
    store.release(spark)
    if not hubs.isEmpty():
        near = store.materialise(_bounded_wide(hubs, nodes, percent), "hub_near")
        found = store.materialise(_verified(near, _sets(read, nodes, _ends(near), words), percent), "hub_links")
        label = _joined(label, found)
        pairs = pairs.unionByName(hubs)
    more = _crossing(tiles, nodes, label, percent).join(pairs, ["a", "b"], "left_anti")
    more = store.materialise(_bounded_wide(more, nodes, percent), "more_near")
    store.release(spark)
    if not more.isEmpty():
        found = store.materialise(_verified(more, _sets(read, nodes, _ends(more), words), percent), "more_links")
        label = _joined(label, found)
    # From nodes to documents: the smallest id of each component, then of each row.
    named = nodes.join(label, nodes["key"] == label["node"], "left").select("key", "doc_id", F.coalesce("component", "key").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    final = named.join(least, "component").select("key", "component_id")
    return rows.join(final, "key", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """Components after some more links."""
    if links.isEmpty():
        return label
    return components(links.unionByName(label.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group; all their columns."""
    stay = link(docs, words, percent, id_col, text_col).filter("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    # A row without an id is in no group.
    loose = docs.filter(docs[id_col].isNull())
    return docs.join(stay, docs[id_col].cast("long") == stay["__id"], "left_semi").unionByName(loose)
