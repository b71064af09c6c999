"""Packing, token files, BPE, sharding, exact copies: against the library or brute force."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brisa.llm import backtrack_bpe, cost_packing, heavy_dedup, simple8b, store, stratified_shards
from brisa.llm.wordpieces import library_encoder
from tests.llm import cases

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    store.prepare(spark)
    return cases.documents(spark)


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


STRANGE = st.text(alphabet=st.sampled_from(list("abTHE's.,!12 \n\t\x1c\xa0é́ß日<|>endoftextİΣ ")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(STRANGE)
def test_cached_chunks_give_the_library_ids(text):
    for path, encoder in ENCODERS.items():
        assert encoder.ids(text).tolist() == LIBRARY[path].encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(STRANGE)
def test_backtracking_gives_the_library_ids(text):
    ids = BACKTRACK.ids(text)
    assert ids.tolist() == LIBRARY[BYTE].encode(text, add_special_tokens=False).ids
    assert backtrack_bpe.vocabulary(BYTE).decode(ids).decode() == text


ENCODERS = {p: library_encoder(p) for p in (WORD, BYTE)}
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}
BACKTRACK = backtrack_bpe.backtracking_encoder(BYTE)


def test_cache_of_chunks_stays_small():
    import tracemalloc

    from brisa.llm import wordpieces

    most = wordpieces.small_library_encoder(WORD)._whole.most
    cache = wordpieces._Cache(lambda c: c[-4:].encode(), most)
    tracemalloc.start()
    try:
        for i in range(750_000):
            cache[f"chunk{i}"]
        assert tracemalloc.get_traced_memory()[0] < 150e6
    finally:
        tracemalloc.stop()
    cache["chunk1"]
    assert dict.__getitem__(cache, "chunk1") == b"unk1" and len(cache) + len(cache.older) <= 2 * most


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=300), st.sampled_from([1, 7, 64, 4096]))
def test_simple8b_round_trip(ids, stride):
    words, offsets = simple8b.encode_words(np.array(ids, dtype=np.uint64), stride)
    assert simple8b.decode_words(words, offsets, len(ids), stride).tolist() == ids


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 9_000), max_size=60))
def test_assign_covers_every_token_and_wastes_one_sequence(lengths):
    pieces = cost_packing.assign(lengths, 2048, 1.0, 1 / 2048)
    per_doc, per_seq = defaultdict(list), defaultdict(list)
    for doc, start, n, seq, offset in pieces:
        per_doc[doc].append((start, n))
        per_seq[seq].append((offset, n))
    for doc, n in enumerate(lengths):
        assert sum(k for _, k in per_doc[doc]) == n
        assert [s for s, _ in sorted(per_doc[doc])] == list(np.cumsum([0] + [k for _, k in sorted(per_doc[doc])])[:-1])
    for parts in per_seq.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [k for _, k in parts])[:-1])
        assert sum(k for _, k in parts) <= 2048
    assert len(per_seq) == sum(n // 2048 for n in lengths) + -(-sum(n % 2048 for n in lengths) // 2048)


def _cheapest_with_room(lengths, capacity, linear, quadratic):
    """Every open sequence looked at for every piece."""
    rest = sorted(((n % capacity, doc, n - n % capacity) for doc, n in enumerate(lengths) if n % capacity), key=lambda x: (-x[0], x[1]))
    first = sum(n // capacity for n in lengths)
    total = sum(n for n, _, _ in rest)
    room = [min(capacity, total - at) for at in range(0, total, capacity)]
    cost, used, out = [0.0] * len(room), [0] * len(room), []
    for left, doc, start in rest:
        while left:
            ready = [s for s, r in enumerate(room) if r >= left] if start % capacity == 0 else []
            s = min(ready or [s for s, r in enumerate(room) if r], key=lambda s: (cost[s], s))
            take = min(left, room[s])
            out.append((doc, start, take, first + s, used[s]))
            start, left, used[s], room[s] = start + take, left - take, used[s] + take, room[s] - take
            cost[s] += linear * take + quadratic * take * take
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 5_000), st.integers(900, 1_100), st.integers(1, 40)), max_size=150))
def test_assign_takes_the_cheapest_sequence_with_room(lengths):
    pieces = [p for p in cost_packing.assign(lengths, 2048, 1.0, 1 / 2048) if p[2] < 2048]
    assert pieces == [p for p in _cheapest_with_room(lengths, 2048, 1.0, 1 / 2048) if p[2] < 2048]


@pytest.mark.parametrize("near_half", [False, True])
def test_assign_of_many_documents(near_half):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1_000, 1_060, 100_000) if near_half else np.maximum(1, rng.lognormal(5.5, 1.2, 100_000).astype(int))
    began = time.process_time()
    pieces = cost_packing.assign(lengths.tolist(), 2048, 1.0, 1 / 2048)
    assert time.process_time() - began < 4
    assert sum(p[2] for p in pieces) == lengths.sum()


def test_costs_are_balanced():
    lengths = [1500] * 8 + [300] * 20 + [60] * 40
    costs = Counter()
    for _, _, n, seq, _ in cost_packing.assign(lengths, 2048, 1.0, 1 / 2048):
        costs[seq] += n + n * n / 2048
    full = sorted(costs.values())[1:]
    assert max(full) < 1.5 * min(full)


def test_pack(spark, docs):
    out = cost_packing.pack(docs, WORD).toPandas()
    want = Counter()
    for doc, text in cases.rows_of(docs):
        want[doc if doc is not None else -1, len(ids_of(WORD, text)) + 1] += len(ids_of(WORD, text)) + 1
    got = Counter()
    for r in out.itertuples():
        got[-1 if r.doc_id != r.doc_id else int(r.doc_id), r.doc_tokens] += r.length
    assert got == want
    single = out[out.doc_id == 15].sort_values("start")
    ids = np.array([*ids_of(WORD, cases.texts()[15]), 1], dtype="<u4")
    assert [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in single.itertuples()] == single.ids_crc32.tolist()
    for _, seq in out.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq.offset.tolist() == (seq.length.cumsum() - seq.length).tolist() and seq.length.sum() <= 2048
    assert cost_packing.pack(cases.no_documents(spark), WORD).count() == 0


def test_id_files(spark, docs):
    out = simple8b.round_trip(docs.filter("doc_id is not null"), BYTE, 2).toPandas()
    want = Counter()
    for doc, text in cases.rows_of(docs.filter("doc_id is not null")):
        want[doc, np.array([*ids_of(BYTE, text), 2], dtype="<u4").tobytes()] += 1
    assert Counter(zip(out.doc_id, map(bytes, out.ids), strict=True)) == want
    out = out.sort_values("start")
    assert out.start.tolist() == (out.n_tokens.cumsum() - out.n_tokens).tolist() and out.doc_id.is_monotonic_increasing
    assert simple8b.round_trip(cases.no_documents(spark), BYTE).count() == 0


def test_encode_decode(spark, docs):
    out = backtrack_bpe.encode_decode(docs, BYTE).toPandas()
    want = Counter((np.array(ids_of(BYTE, t), dtype="<u4").tobytes(), t) for _, t in cases.rows_of(docs))
    assert Counter(zip(map(bytes, out.ids), out.decoded, strict=True)) == want
    digests = backtrack_bpe.encode_decode(docs, BYTE, digests=True).toPandas()
    assert Counter(digests.decoded_sha256) == Counter(hashlib.sha256(t.encode()).hexdigest() for _, t in cases.rows_of(docs))
    assert backtrack_bpe.encode_decode(cases.no_documents(spark), BYTE).count() == 0


def test_shards(spark, docs):
    out = stratified_shards.shard(docs, shards=7).toPandas()
    assert len(out) == docs.count()
    sizes = out.groupby("shard").size()
    assert len(sizes) == 7 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))
    # Every run of shards holds its share of every source, to within one row.
    for source, g in out.groupby(out.source.fillna("-")):
        for k in range(1, 8):
            assert abs((g["shard"] < k).sum() - len(g) * sizes[sizes.index < k].sum() / len(out)) <= 1.5, source
    assert Counter(out["size"]) == Counter(len(t.encode()) + 16 for _, t in cases.rows_of(docs))
    assert stratified_shards.shard(cases.no_documents(spark)).count() == 0
    assert sorted(stratified_shards.shard(docs.limit(3)).toPandas().slot) == [0, 0, 0]


@pytest.mark.parametrize("least", [1, 2, 32])
def test_exact_copies(spark, docs, least):
    out = heavy_dedup.assign(docs, least=least).collect()
    groups = defaultdict(list)
    for doc, text in cases.rows_of(docs):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), -1 if doc is None else doc))
    want = Counter()
    for text, rows in groups.items():
        best = min(rows)
        for row in rows:
            want[row[1], best[1], len(rows), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((-1 if r[0] is None else r[0], -1 if r[1] is None else r[1], r[2], r[4]) for r in out) == want
    assert sum(r["kept"] for r in out) == len(groups)
    left = heavy_dedup.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert heavy_dedup.assign(cases.no_documents(spark)).count() == 0
    assert heavy_dedup.drop_copies(cases.no_documents(spark)).count() == 0
