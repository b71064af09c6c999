"""Repeated strings, near duplicates, near vectors: against brute force."""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from brisa.llm import collision_dedup, components, jaccard_tiles, store, suffix_dedup
from tests.llm import cases


@pytest.fixture(scope="module")
def docs(spark):
    store.prepare(spark)
    return cases.documents(spark)


def smallest(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(500, 560)] + [(900, 900 + i) for i in range(1, 80)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = smallest({x for p in links for x in p}, links)
    assert all(got.get(n, n) == c for n, c in want.items()) and len(got) == len(set(got))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_stop_at_stars(spark, monkeypatch):
    written, write = [], store.materialise
    monkeypatch.setattr(store, "materialise", lambda df, name: write(df, written.append(name) or name))
    # Round one leaves stars; a further one would only see that nothing changes.
    got = components.components(spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)}
    assert len(written) == 2


def test_small_star_keeps_every_node(spark):
    rng = np.random.default_rng(5)
    edges = {(int(max(p)), int(min(p))) for p in rng.integers(0, 60, (150, 2)) if p[0] != p[1]}
    least = {a: min(b for x, b in edges if x == a) for a, _ in edges}
    want = {(b, least[a]) for a, b in edges if b != least[a]} | set(least.items())
    got = components._small(spark.createDataFrame(sorted(edges), "a long, b long"))
    assert {tuple(r) for r in got.collect()} == want


def test_near_copies_free_their_broadcasts(spark, docs, monkeypatch):
    made, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: made.append(send(value)) or made[-1])
    jaccard_tiles.link(docs).count()
    assert made and not any(os.path.exists(b._path) for b in made)


def covered(raws, length):
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        mask = np.zeros(len(r), dtype=bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                mask[i : i + length] = True
        out.append(mask)
    return out


@pytest.mark.parametrize("tuning", [{}, {"hot": 1}, {"chunk": 2}])
def test_repeats(spark, docs, tuning):
    rows = cases.rows_of(docs)
    raws = [t.encode() for _, t in rows]
    want = Counter()
    for (doc, _), raw, mask in zip(rows, raws, covered(raws, 200), strict=True):
        runs = int((np.diff(np.append(0, mask.astype(int))) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        want[doc, len(raw), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    out = suffix_dedup.remove_repeats(docs, digests=True, **tuning).collect()
    assert Counter(tuple(r) for r in out) == want
    if not tuning:
        assert Counter(hashlib.sha256(bytes(r["kept"])).hexdigest() for r in suffix_dedup.remove_repeats(docs).collect()) == Counter(
            k[4] for k in want.elements()
        )
        assert suffix_dedup.remove_repeats(cases.no_documents(spark)).count() == 0


def test_multikey_sort():
    rng = np.random.default_rng(4)
    rows = [bytes(rng.integers(97, 99, int(rng.integers(0, 24)), dtype=np.uint8)).ljust(24, b"\0") for _ in range(300)]
    group = rng.integers(0, 5, 300)
    words = np.frombuffer(b"".join(rows), dtype=">u8").reshape(300, 3).astype(np.uint64)
    order, same = suffix_dedup.multikey_sort(words, group)
    keyed = [(group[i], rows[i]) for i in order]
    assert keyed == sorted(keyed)
    for i in range(1, 300):
        a, b = keyed[i - 1], keyed[i]
        common = next((k for k in range(24) if a[1][k] != b[1][k]), 24)
        assert same[i] == (common if a[0] == b[0] else -1)


def shingle_sets(rows):
    out = []
    for _, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        out.append({tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else ({tuple(found)} if found else set()))
    return out


def linked(sets, percent=80):
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]


def test_jaccard(spark, docs, monkeypatch):
    rows = cases.rows_of(docs)
    sets = shingle_sets(rows)
    comp = smallest(range(len(rows)), linked(sets))
    members = defaultdict(list)
    for i, c in comp.items():
        members[c].append(rows[i][0])
    want = Counter((rows[i][0], len(s), min((d for d in members[comp[i]] if d is not None), default=None)) for i, s in enumerate(sets))
    for hot in (jaccard_tiles.HOT_LEVEL, 0):  # 0: every token goes the way of frequent ones
        monkeypatch.setattr(jaccard_tiles, "HOT_LEVEL", hot)
        assert Counter(tuple(r) for r in jaccard_tiles.link(docs).collect()) == want
    left = jaccard_tiles.keep_one(docs)
    assert left.columns == docs.columns
    assert jaccard_tiles.link(cases.no_documents(spark)).count() == 0


def test_jaccard_chains_and_borders(spark):
    """Chains of near copies whose ends do not link, and sets exactly at the border."""
    import random

    rng = random.Random(9)
    rows = []
    for group in range(12):
        text = cases.words(rng, rng.randint(10, 90)).split()
        for step in range(14):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            if rng.random() < 0.5:
                text[rng.randrange(len(text))] = cases.words(rng, 1)
            else:
                text += cases.words(rng, rng.randint(1, 3)).split()
    sets = shingle_sets(rows)
    links = linked(sets)
    assert any(5 * len(sets[a] & sets[b]) == 4 * len(sets[a] | sets[b]) for a, b in links)
    comp = smallest(range(len(rows)), links)
    out = {r["doc_id"]: r["component_id"] for r in jaccard_tiles.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: comp[i] for i in range(len(rows))}


def test_jaccard_places_leave_unlikely_pairs(spark):
    """Texts of one form that all lack too much of each other meet in no tile; a pair that links does."""
    import random

    rng = random.Random(3)
    form = cases.words(rng, 400).split()
    texts = []
    for i in range(60):
        text = list(form)
        for at in range(i % 20, 400, 28):  # 14 or 15 words, so over a ninth of the shingles are its own
            text[at] = f"own{i}x{at}"
        texts.append(" ".join(text))
    rows = [*enumerate(texts), (60, " ".join([*texts[0].split()[:-2], "other", "end"]))]
    sets = shingle_sets(rows)
    assert linked(sets) == [(60, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    levels = spark.sparkContext.broadcast(jaccard_tiles._levels(jaccard_tiles._describe(docs, 5)))
    tiles = jaccard_tiles._tiles(docs, levels, 5, 80).collect()
    assert {frozenset((r["key"], x)) for r in tiles for x in r["others"]} and len({r["key"] for r in tiles}) == 2
    out = {r["doc_id"]: r["component_id"] for r in jaccard_tiles.link(docs).collect()}
    assert out == {i: i % 60 for i in range(61)}


def vectors(spark, n=300):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((n, 16))
    near = base[:40] + 0.08 * rng.standard_normal((40, 16))
    crowd = base[0] + 0.1 * rng.standard_normal((150, 16))
    rows = [[float(x) for x in v] for v in np.concatenate([base, near, crowd, base[:5], 3 * base[5:8]])]
    rows += [None, [], [0.0] * 16, [None, *[1.0] * 15], [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    table = [(i, v, "x", "y") for i, v in enumerate(rows)] + [(None, rows[1], "x", "y")]
    return spark.createDataFrame(table, "vec_id long, embedding array<double>, node string, v string").repartition(3)


@pytest.mark.parametrize("tuning", [{}, {"per_tile": 20, "block": 16}])
def test_near_vectors(spark, tuning):
    store.prepare(spark)
    table = vectors(spark)
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    fine = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = []
    for i in fine:
        for j in fine:
            if j < i and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.9:
                    links.append((i, j))
    n = Counter(x for p in links for x in p)
    out = collision_dedup.link(table, **tuning).collect()
    got = Counter()
    for r in out:
        got[r["vec_id"]] += r["n_links"]
    want = Counter()
    for i, (vec, _) in enumerate(rows):
        want[vec] += n[i]
    assert set(got) == set(want) and all(got[k] <= want[k] for k in want)
    assert sum(got.values()) >= 0.97 * sum(want.values())
    if not tuning:
        assert got == want
        comp = smallest(range(len(rows)), links)
        members = defaultdict(list)
        for i, c in comp.items():
            members[c].append(rows[i][0])
        least = Counter((rows[i][0], min((d for d in members[c] if d is not None), default=None)) for i, c in comp.items())
        assert Counter((r["vec_id"], r["component_id"]) for r in out) == least
    assert collision_dedup.link(table.limit(0)).count() == 0


def test_counts_needed():
    p = collision_dedup.collision_rate(0.9, 0.8)
    k = collision_dedup.least_collisions(0.9, 0.8, 32, 0.995)
    reach = sum(math.comb(32, i) * p**i * (1 - p) ** (32 - i) for i in range(k, 33))
    assert reach >= 0.995 and k > 16
    rng = np.random.default_rng(1)
    x, z = rng.standard_normal(200_000), rng.standard_normal(200_000)
    y = 0.9 * x + math.sqrt(0.19) * z
    share = np.mean(((x < 0.25) & (y < 0.25)) | ((x > -0.25) & (y > -0.25)))
    assert abs(share - collision_dedup.shared_side(0.9, 0.25)) < 0.005
