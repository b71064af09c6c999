"""Ranked lexical search turned around: documents stream past an index of the items.

The items to search for are few and the documents many, so the inverted index is
built over the items' terms and broadcast, and no document is indexed. A first
pass counts, in every document, the terms that occur in some item, and writes
them as (term number, count) lists with the document's length; the corpus-wide
numbers (documents, terms, documents per item term) are sums over that. A second
pass streams the lists through the index: the weights of a document's terms are
spread over the items that hold them, and every item keeps a bounded heap of its
best documents per task. The heaps are merged in two rounds, by item and a salt
of the task and then by item, so that an item's heaps of very many tasks never
meet in one.

Items are searched in blocks of at most ``block_bytes`` of text, so the driver
and a worker hold one block's index whatever the number of items; all documents
are read for each block.

Score, in 64-bit integers with ``div`` rounding down: a term's weight is
``floor(1000 * ln((2 N + 2) / (2 df + 1)))``, a document's measure
``m = 10 + (90 n N) div L``, its score the sum over the item's distinct terms of
``weight * ((10^9 tf) div (1000 tf + 8 m))``.

Edge cases: null and empty texts have no terms; such documents count for nothing
and such items find nothing. Rows of one ``item_id`` are one item; documents
that repeat are ranked each for themselves; equal scores go by ascending
``doc_id``, a null id last; very long texts are read whole; empty tables give
no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm import store

COUNTED = "doc_id long, n long, terms array<int>, tf array<long>"
HEAPS = "task int, item int, doc_id long, score long"
BLOCK_BYTES = 8 << 20
SALTS = 64
_NO_ID = 1 << 63

# Every ASCII byte that is no letter or digit separates terms; A-Z are read as a-z.
_TABLE = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Terms of a text in order, in UTF-8."""
    return text.encode().translate(_TABLE).split()


class Index:
    """Inverted index over a block of items: term -> number, and the items of each term number."""

    def __init__(self, texts: list[str]):
        self.number: dict[bytes, int] = {}
        postings: list[list[int]] = []
        for item, text in enumerate(texts):
            for term in dict.fromkeys(terms(text)):
                k = self.number.setdefault(term, len(postings))
                if k == len(postings):
                    postings.append([])
                postings[k].append(item)
        self.items = len(texts)
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in postings])]).astype(np.int64)
        self.flat = np.array([i for p in postings for i in p], dtype=np.int64)


def count_terms(docs: DataFrame, number, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a term: how many terms, and the counts of those in the broadcast numbering (written)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for batch in batches:
            ids, sizes, numbers, counts, ends = [], [], [], [], [0]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms(text.as_py())
                if not words:
                    continue
                found = sorted((known[t], c) for t, c in Counter(words).items() if t in known)
                ids.append(doc)
                sizes.append(len(words))
                numbers.extend(k for k, _ in found)
                counts.extend(c for _, c in found)
                ends.append(len(numbers))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tf"],
            )

    return store.materialise(store.documents(docs, id_col, text_col).mapInArrow(run, COUNTED), "term_counts")


def _holding(counted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term number: partial counts per task, one row per term in the end."""
    df = np.zeros(size, dtype=np.int64)
    found = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df[found.column("term").to_numpy()] = found.column("count").to_numpy()
    return df


def spread(contributions: np.ndarray, numbers: np.ndarray, index: Index) -> np.ndarray:
    """Score of every item: each term's contribution added to the items that hold it.

    Added in two halves of 32 bits, which doubles sum without rounding.
    """
    starts, sizes = index.starts[numbers], index.starts[numbers + 1] - index.starts[numbers]
    skip = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    items = index.flat[skip + np.arange(len(skip))]
    each = np.repeat(contributions, sizes)
    low = np.bincount(items, weights=each & 0xFFFFFFFF, minlength=index.items)
    high = np.bincount(items, weights=each >> 32, minlength=index.items)
    return low.astype(np.int64) + (high.astype(np.int64) << 32)


class Heaps:
    """The ``most`` best documents of each item so far; the least of a full heap bars the rest."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(items)]
        self.bar = np.zeros(items, dtype=np.int64)

    def add(self, doc: int | None, scores: np.ndarray) -> None:
        """Offer a document to all items; equal scores prefer the smaller id."""
        key = -(_NO_ID if doc is None else doc)
        for item in np.flatnonzero((scores >= self.bar) & (scores > 0)).tolist():
            heap, entry = self.heaps[item], (int(scores[item]), key)
            if len(heap) < self.most:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.most:
                self.bar[item] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, heap in enumerate(self.heaps):
            for score, key in heap:
                yield item, None if key == -_NO_ID else -key, score


def _best(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _search_block(docs: DataFrame, items: list[tuple], most: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    sc = spark.sparkContext
    index = Index([t for _, t in items])
    number = sc.broadcast(index.number)
    counted = count_terms(docs, number, id_col, text_col)
    documents, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = _holding(counted, len(index.number))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * k + 1))) for k in df.tolist()], dtype=np.int64)
    index.number = {}
    shared = sc.broadcast((index, weights))
    number.unpersist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weights = shared.value
        heaps = Heaps(index.items, most)
        for batch in batches:
            numbers, tf = (batch.column(c).values.to_numpy() for c in (2, 3))
            ends = batch.column(2).offsets.to_numpy()
            for i, (doc, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                a, b = ends[i], ends[i + 1]
                if a < b:
                    m = 10 + (90 * n * documents) // total
                    heaps.add(doc, spread(weights[numbers[a:b]] * ((1_000_000_000 * tf[a:b]) // (1000 * tf[a:b] + 8 * m)), numbers[a:b], index))
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        rows = list(heaps.rows())
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        kinds = [pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([task] * len(rows), pa.int32()), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
            names=["task", "item", "doc_id", "score"],
        )

    heaps = counted.mapInArrow(run, HEAPS).withColumn("salt", F.pmod("task", F.lit(SALTS)))
    some = _best(heaps, ["item", "salt"], most).select("item", "doc_id", "score")
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], "number int, item_id long")
    best = _best(some, ["item"], most)
    return best.join(F.broadcast(names), best["item"] == names["number"]).select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    most: int = 10,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``most`` best documents of each item: ``item_id, rank, doc_id, score``."""
    texts = items.select(F.col(item_id_col).cast("long").alias("item_id"), store.as_text(item_text_col).alias("text"))
    held = store.materialise(texts, "items")
    # Items are dealt to blocks by their id, so an item's rows stay together.
    total = held.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_bytes))
    out = None
    for block in range(blocks):
        mine = held.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        grouped: dict = {}
        for row in mine.toLocalIterator():
            grouped.setdefault(row["item_id"], []).append(row["text"])
        found = _search_block(docs, [(i, " ".join(t)) for i, t in grouped.items()], most, id_col, text_col)
        out = found if out is None else out.unionByName(found)
    return out
