"""Removal of every byte that lies in a 200-byte string occurring twice.

A suffix array over all bytes would cost tens of bytes of shuffle per input
byte. Here suffixes start only at anchors: the smallest (by hash) of the 32-byte
grams inside each 200-byte window, leftmost of equals. Equal windows have equal
anchors at equal offsets, so two windows need comparing only if they share an
anchor gram, and one suffix, about every 85 bytes, stands for all windows that
chose it.

1. One pass writes, per anchor, its gram's hash, a hash of everything its
   windows cover, and its place. Sorting by gram hash drops anchors met once.
   Where the whole covered stretch occurs again, all its windows repeat.
2. What is left are the ends of repeated passages and the edits of near copies.
   Their grams are put into a bitmap of fixed size; a second pass over the texts
   sends the bytes around exactly those anchors.
3. Those sparse suffixes are range-partitioned by their leading bytes, with
   splitters that Spark samples; a whole gram is the smallest unit of a range,
   so each bucket sees all suffixes it has to compare and no comparison is lost
   at a bucket's boundary. Each bucket sorts its suffixes by multikey quicksort
   (eight bytes at a time, only ties go deeper) and likewise the reversed bytes
   before the anchors. A window at offset ``o`` repeats if another suffix shares
   ``200 - o`` bytes to the right and ``o`` to the left: neighbours' common
   lengths in the two orders give both as cluster numbers.
4. Grams with very many different surroundings (``hot`` rows and more) would
   fill one bucket: their windows are hashed one by one and counted by an
   aggregate with map-side combine instead.
5. Spans are gathered per distinct text, joined to the texts, and cut out.

A text that occurs as a whole more than once repeats everywhere; tasks send its
anchors once. Hashes of stretches and windows have 64 bits.

Edge cases: null counts as empty; texts under 200 bytes lose nothing; rows that
repeat are copies of each other; matches never cross documents; empty input
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm import store

GRAM = 32
PIECE = 1 << 22  # windows handled at once inside one text
_LOW = np.uint64((1 << 24) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def anchors(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places, the first and last window that chose each, and the anchors' gram hashes."""
    found = [_anchors(memoryview(raw)[at : at + PIECE + length - 1], length, at) for at in range(0, max(0, len(raw) - length + 1), PIECE)]
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _anchors(raw, length: int, base: int):
    n = len(raw)
    word = np.ndarray((n - 7,), dtype="<u8", buffer=raw, strides=(1,))
    m = n - GRAM + 1
    gram = np.zeros(m, dtype=np.uint64)
    for i in range(0, GRAM, 8):
        gram = _mix(gram * np.uint64(0x9E3779B97F4A7C15) + word[i : i + m])
    # The place in the low bits makes the leftmost of equal grams the smallest.
    order = (gram & ~_LOW) | np.arange(m, dtype=np.uint64)
    w = length - GRAM + 1
    size = -(-m // w) * w
    grid = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    grid[:m] = order
    grid = grid.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    place = (np.minimum(behind[:count], ahead[w - 1 : w - 1 + count]) & _LOW).astype(np.int64)
    change = np.flatnonzero(np.diff(place))
    first, last = np.append(0, change + 1), np.append(change, count - 1)
    at = place[first]
    return at + base, first + base, last + base, gram[at]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _scan(docs: DataFrame, length: int) -> DataFrame:
    """Pass 1: ``key, around, text_key, a, back, ahead, met`` per anchor of each text a task meets first.

    Stretches that a task meets again and again are known to repeat: only two
    of them carry their key (two, so that each finds its like), the others are
    marked ``met`` and get a key of their own, so no frequent line or passage
    fills one partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        met: set[int] = set()
        often: set[int] = set()
        for batch in batches:
            cols: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for text_key, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text_key in met:
                    continue
                met.add(text_key)
                raw = raw.as_py()
                at, first, last, gram = anchors(raw, length)
                view = memoryview(raw)
                around = np.fromiter(
                    (xxhash.xxh3_64_intdigest(view[p : q + length], seed=a - p) for a, p, q in zip(at.tolist(), first.tolist(), last.tolist(), strict=True)),
                    dtype=np.uint64,
                    count=len(at),
                )
                for c, x in zip(cols, (_signed(gram), _signed(around), np.full(len(at), text_key), at, first, last), strict=True):
                    c.append(x)
            if cols[0]:
                key, around, text, at, first, last = (np.concatenate(c) for c in cols)
                turn = _turn(around, often, 2)
                spare = turn >= 2
                own = _signed(_mix(text.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(spare, own, key)), pa.array(around), pa.array(text), pa.array(at.astype(np.int32)), pa.array((at - first).astype(np.int16)), pa.array((last - at).astype(np.int16)), pa.array(spare)],
                    names=["key", "around", "text_key", "a", "back", "ahead", "met"],
                )

    return docs.select("text_key", "raw").mapInArrow(run, "key long, around long, text_key long, a int, back short, ahead short, met boolean")


OFTEN_KEPT = 200_000


def _turn(around: np.ndarray, often: set[int], sent: int) -> np.ndarray:
    """Which occurrence (from 0) of its stretch each row is, as far as the task knows.

    ``often`` remembers stretches that already occurred ``sent`` times in one
    batch; it is bounded, and forgetting one only sends a few more rows.
    """
    order = np.argsort(around, kind="stable")
    head = np.append(True, around[order][1:] != around[order][:-1])
    start = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    turn = np.empty(len(order), dtype=np.int64)
    turn[order] = np.arange(len(order)) - start
    if often:
        turn[np.isin(around, np.fromiter(often, dtype=np.int64, count=len(often)))] += sent
    again = np.unique(around[turn == sent - 1]).tolist() if sent else []
    if len(often) + len(again) > OFTEN_KEPT:
        often.clear()
    often.update(again[:OFTEN_KEPT])
    return turn


def _stretches(docs: DataFrame, bitmap, length: int) -> DataFrame:
    """Pass 2: the bytes around the anchors whose gram is in the bitmap, each distinct stretch once or so per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        bits = bitmap.value
        met: set[int] = set()
        often: set[int] = set()
        for batch in batches:
            rows: list[tuple] = []
            for text_key, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text_key in met:
                    continue
                met.add(text_key)
                raw = raw.as_py()
                at, first, last, gram = anchors(raw, length)
                hit = np.flatnonzero(store.in_bitmap(bits, gram))
                for a, p, q, k in zip(at[hit].tolist(), first[hit].tolist(), last[hit].tolist(), _signed(gram[hit]).tolist(), strict=True):
                    rows.append((k, text_key, a, a - p, q - a, raw[p : q + length]))
            if rows:
                # Equal stretches are settled already; one is enough to compare others with.
                around = np.array([xxhash.xxh3_64_intdigest(r[5], seed=r[3]) for r in rows], dtype=np.uint64).view(np.int64)
                rows = [rows[i] for i in np.flatnonzero(_turn(around, often, 1) < 1).tolist()]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["key", "text_key", "a", "back", "ahead", "bytes"],
                )

    return docs.select("text_key", "raw").mapInArrow(run, "key long, text_key long, a int, back short, ahead short, bytes binary")


def multikey_sort(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``words`` by group and content, and each row's bytes in common with the one before.

    Multikey quicksort with a 64-bit big-endian word as the character: rows are
    sorted by one character inside each tie, and only rows still tied go on.
    Rows of different groups have -1 in common.
    """
    order = np.argsort(group, kind="stable")
    same = np.zeros(len(order), dtype=np.int64)
    tie = np.zeros(len(order), dtype=bool)  # tied with the row before so far
    if len(order):
        tie[1:] = group[order[1:]] == group[order[:-1]]
    same[~tie] = -1
    for d in range(words.shape[1]):
        tied = tie | np.append(tie[1:], False)
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run = np.cumsum(~tie[at])
        value = words[order[at], d]
        by = np.lexsort((value, run))
        order[at], value = order[at][by], value[by]
        inner = at[tie[at]]
        differ = value[1:] ^ value[:-1]
        here = np.append(np.uint64(0), differ)[tie[at]]
        same[inner] += np.where(here == 0, 8, _leading_bytes(here))
        tie[inner] = here == 0
    return order, same


def _leading_bytes(x: np.ndarray) -> np.ndarray:
    """Zero bytes above the highest set byte of each word."""
    out = np.zeros(len(x), dtype=np.int64)
    for k in range(1, 8):
        out += x < (np.uint64(1) << np.uint64(64 - 8 * k))
    return out


def _packed(parts: list[bytes], width: int) -> np.ndarray:
    """Byte strings as rows of big-endian words, zero-filled to ``width`` bytes."""
    width = -(-width // 8) * 8
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=">u8").reshape(len(parts), -1).astype(np.uint64)


def repeated_windows(key, back, ahead, stretch: list[bytes], length: int) -> np.ndarray:
    """For every row and offset ``o`` (window start = anchor - o): whether that window occurs in another row."""
    n, widest = len(key), length - GRAM
    group = np.unique(key, return_inverse=True)[1]
    right = _packed([s[b:] for s, b in zip(stretch, back.tolist(), strict=True)], length)
    left = _packed([s[:b][::-1] for s, b in zip(stretch, back.tolist(), strict=True)], widest + 1)
    out = np.zeros((n, widest + 1), dtype=bool)
    r_order, r_same = multikey_sort(right, group)
    l_order, l_same = multikey_sort(left, group)
    r_cluster, l_cluster = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    low = -ahead
    for o in range(widest + 1):
        rows = np.flatnonzero((low <= o) & (o <= back))
        if len(rows) < 2:
            continue
        r_cluster[r_order] = np.cumsum(r_same < length - o)
        l_cluster[l_order] = np.cumsum(l_same < o)
        both = r_cluster[rows] * (n + 1) + l_cluster[rows]
        by = np.argsort(both)
        equal = both[by][1:] == both[by][:-1]
        out[rows[by[1:][equal]], o] = True
        out[rows[by[:-1][equal]], o] = True
    return out


def _runs(flags: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the spans of each row's flagged windows."""
    edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(edge == 1)
    high = np.nonzero(edge == -1)[1] - 1
    return row, at[row] - high, at[row] - low + length


def _compare(buckets: DataFrame, length: int, chunk: int) -> DataFrame:
    """``text_key, start, end`` of what repeats, from key-sorted buckets."""

    def resolve(table: pa.Table) -> pa.RecordBatch:
        get = lambda c: table.column(c).to_numpy().astype(np.int64)
        flags = repeated_windows(get("key"), get("back"), get("ahead"), table.column("bytes").to_pylist(), length)
        row, start, end = _runs(flags, get("a"), length)
        return pa.RecordBatch.from_arrays(
            [pa.array(get("text_key")[row]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
            names=["text_key", "start", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= chunk:
                table = pa.Table.from_batches(held)
                key = table.column("key").to_numpy()
                cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
                if cut:
                    yield resolve(table.slice(0, cut).combine_chunks())
                held = table.slice(cut).combine_chunks().to_batches()
                count = table.num_rows - cut
        if count:
            yield resolve(pa.Table.from_batches(held))

    return buckets.mapInArrow(run, "text_key long, start int, end int")


def _compare_hot(rows: DataFrame, length: int) -> DataFrame:
    """The same for frequent grams: every window hashed, counted, and joined back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for row in batch.to_pylist():
                view, n = memoryview(row["bytes"]), len(row["bytes"]) - length + 1
                window = np.fromiter((xxhash.xxh3_64_intdigest(view[i : i + length]) for i in range(n)), dtype=np.uint64, count=n)
                first = row["a"] - row["back"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(window)), pa.array(np.full(n, row["text_key"])), pa.array(np.arange(first, first + n, dtype=np.int32))],
                    names=["window", "text_key", "start"],
                )

    windows = store.materialise(rows.mapInArrow(run, "window long, text_key long, start int"), "hot_windows")
    twice = windows.groupBy("window").agg(F.count("*").alias("c")).filter("c > 1").select("window")
    return windows.join(twice, "window").select("text_key", "start", (F.col("start") + length).alias("end"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = store.as_text(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text, F.octet_length(text)).alias("text_key"), text.cast("binary").alias("raw"))


def repeated_spans(texts: DataFrame, length: int = 200, chunk: int = 20_000, hot: int = 20_000) -> DataFrame:
    """``text_key, start, end``: byte spans (they may overlap) that cover every repeated string.

    ``texts`` has ``text_key`` (a hash of the text) and ``raw``.
    """
    spark = texts.sparkSession
    long_enough = texts.filter(F.octet_length("raw") >= length)
    whole = long_enough.groupBy("text_key").agg(F.count("*").alias("c"), F.max(F.octet_length("raw")).alias("end")).filter("c > 1")
    key, stretch = Window.partitionBy("key"), Window.partitionBy("key", "around")
    met = store.materialise(
        _scan(long_enough, length)
        .withColumns({"n_key": F.count("*").over(key), "n_around": F.count("*").over(stretch)})
        .filter("met or n_key > 1")
        .drop("around"),
        "anchors",
    )
    full = met.filter("met or n_around > 1").select(
        "text_key", (F.col("a") - F.col("back")).alias("start"), (F.col("a") + F.col("ahead") + length).alias("end")
    )
    open_keys = met.filter("not met and n_around = 1").select("key", "n_key").distinct()
    spans = [full, whole.select("text_key", F.lit(0).alias("start"), "end")]
    bitmap = spark.sparkContext.broadcast(store.bitmap(open_keys, F.col("key")))
    suffixes = store.materialise(_stretches(long_enough, bitmap, length), "suffixes")
    frequent = open_keys.filter(F.col("n_key") >= hot).select("key")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lead = F.expr("substring(bytes, back + 1, 8)")
    buckets = suffixes.join(frequent, "key", "left_anti").withColumn("lead", lead).repartitionByRange(n, "lead", "key")
    spans.append(_compare(buckets.sortWithinPartitions("lead", "key").drop("lead"), length, chunk))
    if not frequent.isEmpty():
        spans.append(_compare_hot(suffixes.join(frequent, "key", "left_semi"), length))
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    return out


def remove_repeats(
    docs: DataFrame, length: int = 200, digests: bool = False, id_col: str = "doc_id", text_col: str = "text", **tuning
) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans`` and the bytes that stay (``kept``, or ``kept_sha256`` with ``digests``)."""
    texts = _texts(docs, id_col, text_col)
    spans = repeated_spans(texts, length, **tuning)
    # Spans of one distinct text; their number is bounded by the text's length.
    gathered = store.materialise(
        spans.distinct().groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")), "spans"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, runs, kept = [], [], [], []
            for raw, spans in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = raw.as_py()
                parts, at, cut, count = [], 0, 0, 0
                for s in spans or []:
                    if s["start"] > at or (not count and s["start"] == at):
                        parts.append(raw[at : s["start"]])
                        count += 1
                        cut += s["end"] - s["start"]
                    else:
                        cut += max(0, s["end"] - at)
                    at = max(at, s["end"])
                parts.append(raw[at:])
                left = b"".join(parts)
                size.append(len(raw))
                removed.append(cut)
                runs.append(count)
                kept.append(hashlib.sha256(left).hexdigest() if digests else left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.string() if digests else pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", last],
            )

    last = "kept_sha256" if digests else "kept"
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, {last} {'string' if digests else 'binary'}"
    return texts.join(gathered, "text_key", "left").select("doc_id", "raw", "spans").mapInArrow(run, schema)
