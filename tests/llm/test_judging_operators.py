"""Toxicity by held-out accuracy, personal data by brute force, the pipeline end to end."""

from __future__ import annotations

import os
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from brisa.llm import store, subword_toxicity, weak_pii
from brisa.llm.queries import QUERIES
from tests.llm import cases

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@pytest.fixture(scope="module")
def docs(spark):
    store.prepare(spark)
    return cases.documents(spark)


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    kinds = list(PATTERNS)
    found = sorted((m.start(), kinds.index(k), m.end()) for k in kinds for m in re.finditer(PATTERNS[k], text) if valid(k, m.group()))
    return [(kinds[k], a, b) for a, k, b in found]


def test_base_spans(spark, docs):
    more = [
        "a@b.co_x@d.com y@z.1-2.q. %@-.-",
        "1.2.3.4.5.6.7.8 0001.02.3.255 256.1.1.1 1.2.3",
        "4111-1111 1111-1111 5 4111111111111111 41111111111111110000000 4 1 1",
        "+49 (30) 901820 12, +1 +2 5551234567 ++49 30 9018 2012- +1234567890123456",
        "🙂 x@y.zz 🙂 +1 (132) 555-1352 " * 3,
    ]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    out = weak_pii.find(table).collect()
    want = Counter()
    for doc, text in cases.rows_of(table):
        spans = base_spans(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[(doc, *[sum(s[0] == k for s in spans) for k in PATTERNS], hashlib.sha256(listed.encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:6] for r in out) == want
    texts = dict(cases.rows_of(table))
    for r in out:
        spans = [s for s in r["spans"].split(",") if s]
        assert {f"{k}:{a}:{b}" for k, a, b in base_spans(texts[r["doc_id"]])} <= set(spans)
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
    assert weak_pii.find(cases.no_documents(spark)).count() == 0


def test_method_adds_what_the_labelers_support(spark):
    rng = random.Random(3)
    rows = [f"{cases.words(rng, 6)} phone: +1 (132) 555-{rng.randint(1000, 9999)} {cases.words(rng, 3)}" for _ in range(120)]
    rows += [f"{cases.words(rng, 6)} phone: (132) 555-{rng.randint(1000, 9999)} {cases.words(rng, 3)}" for _ in range(40)]
    rows += [f"order 132-555-{rng.randint(1000, 9999)}x {cases.words(rng, 5)}" for _ in range(120)]
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r["doc_id"]: r["spans"] for r in weak_pii.find(table).collect()}
    assert all("phone" in out[i] for i in range(160))
    assert not any(out[i] for i in range(160, 280))


def test_secrets_are_told_from_other_hashes(spark):
    """No pattern decides: the same 40 digits count or not by what the labelers see around them."""
    rng = random.Random(4)
    digits = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(90)]
    rows = [f'{cases.words(rng, 4)} token = "{x}" {cases.words(rng, 3)}' for x in digits]
    rows += [f"{cases.words(rng, 4)} commit {x} {cases.words(rng, 3)}" for x in digits]
    rows += [f"{cases.words(rng, 3)} well-known-slug-of-2020-with-words {cases.words(rng, 3)}" for _ in range(30)]
    rows += ["x" * 400, "9" * 40, "4111 1111 1111 1112 is no card"]
    out = {r["doc_id"]: r for r in weak_pii.find(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    for i, x in enumerate(digits):
        at = rows[i].index(x)
        assert f"secret:{at}:{at + 40}" in out[i]["spans"].split(",") and out[i]["n_secret"] == 1
    assert not any("secret" in out[i]["spans"] or out[i]["n_secret"] for i in range(90, len(rows)))
    assert out[len(rows) - 1]["spans"] == ""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the given tables")
def test_op1_query(spark):
    rows = QUERIES["op1_weak_pii"][0](spark, "/root/testdata/sf0.01").collect()
    texts = dict(cases.rows_of(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        base = base_spans(texts[r["doc_id"]])
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = [s for s in r["spans"].split(",") if s]
        assert set(listed) <= set(spans)
        # Beyond the base: the keys of these texts, all of them and little else.
        keys = [f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', texts[r["doc_id"]])]
        assert set(keys) <= set(spans) and r["n_secret"] == len(keys)
    assert sum(r["n_secret"] for r in rows) > 0


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.4
    right = [0.95, 0.85, 0.7, 0.65, 0.6]
    votes = np.array([np.where(rng.random(20_000) < r, np.where(truth, 1, -1), np.where(truth, -1, 1)) for r in right]).T
    counts = Counter(map(tuple, votes.tolist()))
    posterior, reliability = weak_pii.expectation_maximisation([("email", v, n) for v, n in counts.items()])
    for name, r in zip(weak_pii.LABELERS, right, strict=True):
        assert abs(reliability[f"email:{name}:1:1"] - r) < 0.05
    guess = np.array([posterior["email", tuple(v)] >= 0.5 for v in votes.tolist()])
    assert (guess == truth).mean() > 0.94


def test_redact(spark, docs):
    out = weak_pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = out.filter("doc_id = 15").first()["text"]
    assert text.startswith("mail <EMAIL>, <PHONE> at <IP>; <CARD> é日本")
    assert out.filter("doc_id = 0").first()["text"] is None
    assert weak_pii.redact(cases.no_documents(spark)).count() == 0


BAD = ["idiot", "moron", "pathetic", "worthless", "disgusting"]


def bend(rng, word):
    i = rng.randrange(1, len(word) - 1)
    return rng.choice([word[:i] + word[i] * 2 + word[i + 1 :], word[:i] + "*" + word[i + 1 :], word + "sss", word.upper()])


def labelled(spark, n=1500):
    rng = random.Random(11)
    rows, labels = [], []
    common = cases.words(rng, 2000).split()
    for i in range(n):
        found = rng.choices(common, k=rng.randint(10, 120))
        toxic = i % 6 == 0
        for _ in range(4 if toxic else 0):
            word = rng.choice(BAD)
            found[rng.randrange(len(found))] = bend(rng, word) if subword_held_out(i) else word
        rows.append((i, " ".join(found)))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (1, 1, None), (10_000, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def subword_held_out(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 4 == 2


def test_unseen_misspellings(spark):
    store.prepare(spark)
    table, labels = labelled(spark)
    model = subword_toxicity.fit(table, labels)
    got = {r["doc_id"]: r["score"] for r in subword_toxicity.score(table, model).collect()}
    held = [i for i in got if subword_held_out(i)]
    hit = [i for i in held if got[i] >= 0.3]
    true = [i for i in held if i % 6 == 0]
    assert len(set(hit) & set(true)) >= 0.7 * len(true)
    assert len(set(hit) - set(true)) <= 0.05 * len(held)
    # Labels of held-out rows teach nothing.
    import pyspark.sql.functions as F

    turned = labels.withColumn("toxic", F.when(subword_toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = subword_toxicity.fit(table, turned)
    assert np.array_equal(again.table, model.table) and again.bias == model.bias


def test_toxicity_edges(spark, docs):
    _, labels = labelled(spark)
    model = subword_toxicity.fit(docs, labels)
    out = subword_toxicity.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    left = subword_toxicity.drop_toxic(docs, model)
    assert left.schema.names == docs.schema.names
    assert left.count() == sum(r["score"] < 0.3 for r in out)
    none = subword_toxicity.fit(cases.no_documents(spark), labels.limit(0))
    assert subword_toxicity.score(cases.no_documents(spark), none).count() == 0
    assert subword_toxicity.drop_toxic(docs, none).count() == docs.count()


def test_pipeline_stages_keep_the_columns(spark, docs, tmp_path):
    _, labels = labelled(spark)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (docs, cases.no_documents(spark)):
        now, before = table, table.count()
        for name, stage in corpus_pipeline.STAGES:
            now = store.materialise(stage(spark, now, str(tmp_path)), name)
            if name != "packing":
                assert now.columns == docs.columns, name
                assert now.count() <= before
                before = now.count()
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_on_the_smallest_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    packed = corpus_pipeline.run(spark, sf_dir)
    assert 0.5 * documents < packed.select("doc_id").distinct().count() <= documents


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_sql(spark, name):
    import duckdb

    query, sql = QUERIES[name]
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got = query(spark, sf_dir)
    want = con.execute(sql).to_arrow_table().select(got.columns).to_pylist()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str(tuple(r.values())) for r in want)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the given tables")
def test_op4_query_on_the_given_labels(spark):
    """Held-out rows of the given labels; training never reads them."""
    from brisa.llm.queries import op4_subword_toxicity

    d = "/root/testdata/sf0.1"
    out = op4_subword_toxicity(spark, d)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    toxic: dict[int, int] = {}
    for r in spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic").collect():
        toxic[r["doc_id"]] = max(toxic.get(r["doc_id"], 0), r["toxic"])
    assert all(r["held_out"] == subword_held_out(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    hits = sum(r["predicted"] and toxic[r["doc_id"]] for r in held)
    assert hits >= 0.85 * sum(toxic[r["doc_id"]] for r in held)
    assert hits >= 0.85 * sum(r["predicted"] for r in held)
