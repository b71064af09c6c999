"""Cost-balanced packing of tokenised documents into fixed-length sequences.

Attention over a packed sequence costs ``linear * tokens + quadratic * sum of
squared piece lengths``. Documents longer than a sequence give full pieces
first; what is left of every document is placed in descending length into the
cheapest open sequence that still has room, so costly sequences stop growing
first. A piece that fits nowhere whole is cut over the cheapest open
sequences, so at most one sequence of a block is left partly empty. Every open
sequence is considered for every piece: those too full wait by remaining room,
so a block takes time in proportion to ``n log n`` whatever the lengths.

Scale: one map-only pass. Each task packs its own documents in blocks of
bounded token count; no shuffle, no key, so no group can be hot, and a lost
task is redone alone. ``sequence_id`` is made of the partition, the block and
the sequence within it.

Edge cases: null and empty texts consist of the end id alone; a repeated row
is a document of its own; empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from brisa.llm import store
from brisa.llm.wordpieces import library_encoder, small_library_encoder, worker_encoder

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
)


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` for documents of the given lengths.

    The number of open sequences is the least that can hold the remainders.
    """
    out, sequence = [], 0
    rest = []
    for doc, n in enumerate(lengths):
        full = n // capacity
        for i in range(full):
            out.append((doc, i * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rest.append((n % capacity, doc, full * capacity))
    rest.sort(key=lambda x: (-x[0], x[1]))
    total = sum(x[0] for x in rest)
    used = [0] * -(-total // capacity)
    # All but the last sequence must end full, so the last takes what is over.
    room = [capacity] * len(used)
    if room:
        room[-1] = total - capacity * (len(used) - 1)
    cost = [0.0] * len(used)
    # Pieces come in descending length, so a sequence too full for one piece may
    # suit a later one: it waits under its room until pieces are that short.
    fits: list[tuple[float, int]] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    short: list[tuple[float, int, int]] = []  # who waited, by cost; out of date where the room has changed
    shortest = capacity + 1

    def keep(s: int) -> None:
        if room[s] >= shortest:
            heapq.heappush(fits, (cost[s], s))
        elif room[s]:
            waiting[room[s]].append(s)
            heapq.heappush(short, (cost[s], s, room[s]))

    for s in range(len(used)):
        keep(s)
    for left, doc, start in rest:
        for r in range(left, min(shortest, capacity + 1)):
            for s in waiting[r]:
                if room[s] == r:
                    heapq.heappush(fits, (cost[s], s))
            waiting[r] = []
        shortest = left
        need = left
        while need:
            if fits:
                _, s = heapq.heappop(fits)
            else:
                # Nothing has room for the whole piece: cut it, cheapest first.
                _, s, r = heapq.heappop(short)
                if room[s] != r:
                    continue
            take = min(need, room[s])
            out.append((doc, start, take, sequence + s, used[s]))
            start += take
            need -= take
            used[s] += take
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            keep(s)
    return out


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    block_tokens: int = 4_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    small_cache: bool = False,
) -> DataFrame:
    """One row per piece (``SCHEMA``); ``cost`` is that of the piece's whole sequence.

    ``vocabulary`` is the path of a ``tokenizers`` file that every executor can open.
    ``small_cache`` takes less memory a worker and more time, for the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(small_library_encoder if small_cache else library_encoder, vocabulary)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        block, docs_in, ids_in, tokens = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = [len(x) // encoder.dtype.itemsize for x in ids_in]
            pieces = assign(lengths, capacity, linear, quadratic)
            base = (part << 40) | (block << 24)
            costs: dict[int, float] = {}
            for _, _, n, s, _ in pieces:
                costs[s] = costs.get(s, 0.0) + linear * n + quadratic * n * n
            crcs = []
            for d, start, n, _, _ in pieces:
                ids = np.frombuffer(ids_in[d], encoder.dtype)[start : start + n]
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([docs_in[p[0]] for p in pieces], pa.int64()),
                    pa.array([p[1] for p in pieces], pa.int64()),
                    pa.array([p[2] for p in pieces], pa.int64()),
                    pa.array(crcs, pa.int64()),
                    pa.array([lengths[p[0]] for p in pieces], pa.int64()),
                    pa.array([base | p[3] for p in pieces], pa.int64()),
                    pa.array([p[4] for p in pieces], pa.int64()),
                    pa.array([costs[p[3]] for p in pieces], pa.float64()),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"],
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.packed(text.as_py()) + end
                docs_in.append(doc)
                ids_in.append(ids)
                tokens += len(ids) // encoder.dtype.itemsize
                if tokens >= block_tokens:
                    yield flush()
                    block, docs_in, ids_in, tokens = block + 1, [], [], 0
        if docs_in:
            yield flush()

    return store.documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)
