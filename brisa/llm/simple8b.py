"""Token ids as Simple-8b words in block files, and the reader.

A 64-bit word has a 4-bit selector and 60 data bits: selector ``s`` packs
``COUNTS[s]`` ids of ``60 // COUNTS[s]`` bits each, the first in the lowest
bits. Selector 15 is the escape: the next word holds one whole id. A block
holds a run of documents: its place in the partition's stream, their ids, how
many tokens each has, the packed words, and one word offset for every
``STRIDE`` ids, so that a reader can enter a block without decoding what comes
before.

Documents are laid out in ascending ``doc_id`` by sampled range partitions,
sorted inside each, so files concatenate in order. Blocks are rows of a Parquet
table under the shared folder: Spark commits each task's file whole, so lost
executors leave no torn files, and any store that Spark reads can hold them.
The position of a document in the whole stream is its position in its
partition plus the total of the partitions before (one number a partition).

Edge cases: null and empty texts hold the end id alone; rows that repeat a
``doc_id`` follow each other (equal texts in any order, which is the same
stream); empty input gives an empty table; other columns are not read. Ids up
to 2**60 - 1 pack; larger ones (up to 2**64 - 1) are escaped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brisa.llm import store
from brisa.llm.wordpieces import RankEncoder, worker_encoder
from brisa.session import scratch_path

# Ids per word by selector (60 data bits); 15 is the escape.
COUNTS = [60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [60 // c for c in COUNTS]
ESCAPE = 15
STRIDE = 4096

FILE_SCHEMA = "part int, at long, n_ids long, doc_ids array<long>, doc_tokens array<int>, offsets array<int>, words binary"


# How to build the largest need over each count of ids from smaller windows: count = first + second.
_SPLITS = {2: (1, 1), 3: (2, 1), 4: (2, 2), 5: (4, 1), 6: (3, 3), 7: (6, 1), 8: (4, 4), 10: (5, 5), 12: (6, 6), 15: (10, 5), 20: (10, 10), 30: (15, 15), 60: (30, 30)}
_LIMITS = np.array([1 << b for b in BITS], dtype=np.uint64)
_NEED = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def encode_words(ids: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Packed words, and the word offset at which each stride of ids begins.

    Greedy: each word takes as many ids as its widest one allows. The need of
    an id is the first selector with enough bits for it; running maxima of the
    needs tell for every start which selector holds there, so only the walk
    from word to word is a loop. No word crosses a stride.
    """
    ids = np.asarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    need = _NEED[ids] if ids.max() < 1 << 16 else np.searchsorted(_LIMITS, ids, side="right").astype(np.uint8)
    rows = -(-n // stride)
    # What lies behind a stride's end needs nothing: the last word may be filled with zeros.
    window = {1: np.zeros((rows, stride + 60), dtype=np.uint8)}
    flat = np.zeros(rows * stride, dtype=np.uint8)
    flat[:n] = need
    window[1][:, :stride] = flat.reshape(rows, stride)
    for count, (a, b) in _SPLITS.items():
        w = window[a].copy()
        np.maximum(w[:, :-a], window[b][:, a:], out=w[:, :-a])
        window[count] = w
    choice = np.full((rows, stride), ESCAPE, dtype=np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        choice[window[COUNTS[s]][:, :stride] <= s] = s
    choice = choice.ravel()[:n]
    step = np.array([*COUNTS, 0, 1], dtype=np.int64)[choice].tolist()
    starts: list[int] = []
    firsts = []
    for at in range(0, n, stride):
        firsts.append(len(starts))
        p, end = at, min(n, at + stride)
        while p < end:
            starts.append(p)
            p += step[p]
    starts = np.array(starts, dtype=np.int64)
    sel = choice[starts].astype(np.int64)
    width = 1 + (sel == ESCAPE)
    place = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), dtype=np.uint64)
    out[place] = sel.astype(np.uint64) << np.uint64(60)
    for s, (count, bits) in enumerate(zip(COUNTS, BITS, strict=True)):
        mine = starts[sel == s]
        if len(mine):
            index = mine[:, None] + np.arange(count)[None, :]
            ends = np.minimum((mine // stride + 1) * stride, n)[:, None]
            lanes = np.where(index < ends, ids[np.minimum(index, n - 1)], np.uint64(0))
            shift = (np.arange(count) * bits).astype(np.uint64)
            out[place[sel == s]] |= np.bitwise_or.reduce(lanes << shift, axis=1)
    raw = sel == ESCAPE
    out[place[raw] + 1] = ids[starts[raw]]
    return out, place[firsts].astype(np.int32)


def decode_words(words: np.ndarray, offsets: np.ndarray, n: int, stride: int = STRIDE) -> np.ndarray:
    """The ``n`` ids of a block."""
    out = np.zeros(n, dtype=np.uint64)
    if not n:
        return out
    ends = [*offsets[1:].tolist(), len(words)]
    for k, (a, b) in enumerate(zip(offsets.tolist(), ends, strict=True)):
        out[k * stride : min(n, (k + 1) * stride)] = _decode_stride(words[a:b], min(n - k * stride, stride))
    return out


def _decode_stride(words: np.ndarray, n: int) -> np.ndarray:
    sel = (words >> np.uint64(60)).astype(np.int64)
    if (sel == ESCAPE).any():
        # A word after an escape is data whatever its top bits are.
        data = np.zeros(len(words), dtype=bool)
        for i in np.flatnonzero(sel == ESCAPE).tolist():
            if not data[i]:
                data[i + 1] = True
        sel[data] = -1
    counts = np.where(sel < 0, 0, np.array([*COUNTS, 0, 1])[sel])
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for s, (count, bits) in enumerate(zip(COUNTS, BITS, strict=True)):
        mine = np.flatnonzero(sel == s)
        if len(mine):
            shift = (np.arange(count) * bits).astype(np.uint64)
            mask = np.uint64((1 << bits) - 1)
            out[first[mine][:, None] + np.arange(count)[None, :]] = (words[mine][:, None] >> shift) & mask
    raw = np.flatnonzero(sel == ESCAPE)
    out[first[raw]] = words[raw + 1]
    return out[:n]


def write_ids(
    docs: DataFrame,
    vocabulary: str,
    path: str,
    end_id: int = 2,
    block_ids: int = 1 << 18,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the id stream of ``docs`` in ascending ``doc_id`` to ``path``."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(RankEncoder, vocabulary)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        written, doc_ids, packed, held = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            words, offsets = encode_words(np.frombuffer(b"".join(packed), encoder.dtype))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([written], pa.int64()),
                    pa.array([held], pa.int64()),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([[len(x) // encoder.dtype.itemsize for x in packed]], pa.list_(pa.int32())),
                    pa.array([offsets.tolist()], pa.list_(pa.int32())),
                    pa.array([words.astype("<u8").tobytes()], pa.binary()),
                ],
                names=["part", "at", "n_ids", "doc_ids", "doc_tokens", "offsets", "words"],
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.packed(text.as_py()) + end
                doc_ids.append(doc)
                packed.append(ids)
                held += len(ids) // encoder.dtype.itemsize
                if held >= block_ids:
                    yield flush()
                    written, doc_ids, packed, held = written + held, [], [], 0
        if doc_ids:
            yield flush()

    ordered = store.documents(docs, id_col, text_col).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """One row per document from the files: ``doc_id, start, n_tokens, ids`` (ids as packed little-endian uint32).

    With ``digests`` the ids leave as their unsigned CRC-32, ``ids_crc32``.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # One row per written partition (their number is the writer's shuffle setting, not the data's size).
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["doc_tokens"], dtype=np.int64)
                words = np.frombuffer(row["words"], "<u8")
                ids = decode_words(words, np.array(row["offsets"], dtype=np.int64), int(lengths.sum())).astype("<u4")
                ends = np.cumsum(lengths)
                each = [ids[b - k : b] for b, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["part_start"] + row["at"] + ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array([zlib.crc32(x) for x in each], pa.int64()) if digests else pa.array([x.tobytes() for x in each], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", last],
                )

    last = "ids_crc32" if digests else "ids"
    schema = f"doc_id long, start long, n_tokens long, {last} {'long' if digests else 'binary'}"
    return files.join(F.broadcast(before), "part").mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2, digests: bool = False) -> DataFrame:
    """Write ``docs`` and read the files back."""
    path = scratch_path(docs.sparkSession, "simple8b")
    write_ids(docs, vocabulary, path, end_id)
    return read_ids(docs.sparkSession, path, digests)
