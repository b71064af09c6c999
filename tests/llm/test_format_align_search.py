"""Chat examples, token alignment, lexical search: the queries and the operators against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brisa.llm import prefix_targets, queries, reversed_search, store, token_alignment
from brisa.llm.wordpieces import RankEncoder
from brisa.session import scratch_path
from tests.llm import cases

SF = "/root/testdata/sf0.001"
BYTE, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def docs(spark):
    store.prepare(spark)
    return cases.documents(spark)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- chat examples ---

CHAT_SCHEMA = "conv_id long, turn long, role string, text string, head string, body string, part int, block int, example string"
CONTROL = ["", "\\", "\\\\", "<turn>", "</turn>", "</turn>\n", "\\</turn>", "a\nb", "<turn>assistant\n", "日本 👩‍👩‍👧", "\n", "$1 \\1"]


def chat_rows():
    rng = random.Random(3)
    rows = [(0, k, ("user", "assistant")[k % 2], c) for k, c in enumerate(CONTROL * 2)]
    rows += [(1, 0, "system", "only context"), (1, 1, "user", None)]
    rows += [(2, 0, "assistant", "starts"), (2, 1, "assistant", ""), (2, 2, "user", "tail")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "still answered")]
    rows += [(3, None, "user", "null turn comes first"), (3, 0, None, "no role"), (3, 1, "assi\nst\\ant", "odd role"), (3, 2, "assistant", "x" * 5000)]
    rows += [(4, 0, "user", "the same row")] * 3 + [(4, 1, "assistant", "again")] * 2
    rows += [(5, k, rng.choice(["user", "assistant"]), cases.words(rng, 12)) for k in range(300)]  # a conversation over many tasks and blocks
    return [(*r, "h", "b", 1, 2, "e") for r in rows]


def chat_brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, found in turns.items():
        found.sort(key=lambda r: r[:3])
        replies = [t for _, _, role, t in found if role == "assistant"]
        size = 0
        formatted, last = 0, len(found) - 1
        for k, (_, _, role, text) in enumerate(found):
            escape = lambda s: re.sub(r"(\\|</?turn>)", r"\\\1", s)
            size += len("<turn>" + escape(role).replace("\n", "\\\n") + "\n" + escape(text) + "</turn>\n")
            if role == "assistant" or k == last:
                formatted += size
        out[conv] = (len(found), sha("".join(f"{r}\n{t}\n" for _, _, r, t in found)), sum(map(len, replies)), sha("".join(replies)), formatted)
    return out


def as_dict(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: r[1:] for r in rows}


@pytest.mark.parametrize("block", [1, 700, 1 << 20])
def test_chat_round_trip(spark, block):
    rows = chat_rows()
    turns = spark.createDataFrame(rows, CHAT_SCHEMA).repartition(5)
    assert as_dict(prefix_targets.round_trip(turns, block)) == chat_brute([r[:4] for r in rows])


@pytest.mark.parametrize("block", [1, 400, 1 << 20])
def test_every_assistant_turn_has_its_own_example(spark, block):
    rows = [r for r in chat_rows() if r[0] in (0, 1, 2)]
    path = scratch_path(spark, "examples")
    prefix_targets.write_examples(spark.createDataFrame(rows, CHAT_SCHEMA).repartition(3), path, block)
    found = defaultdict(list)
    for r in prefix_targets.examples(spark, path).collect():
        found[r["conv_id"], r["example"]].append(r)
    for conv in (0, 1, 2):
        mine = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        targets = [k for k, (role, _) in enumerate(mine) if role == "assistant"]
        rest = [len(mine) - 1] if not targets or targets[-1] < len(mine) - 1 else []
        assert sorted(e for c, e in found if c == conv) == list(range(len(targets) + len(rest)))
        for example, k in enumerate(targets + rest):
            pieces = sorted(found[conv, example], key=lambda r: r["piece"])
            assert prefix_targets.parse("".join(p["text"] for p in pieces)) == mine[: k + 1]
            assert [p["trainable"] for p in pieces] == [None] * (len(pieces) - 1) + [example < len(targets)]
            end = pieces[-1]
            reply = prefix_targets.unescaped(end["text"][end["loss_start"] : end["loss_end"]])
            assert reply == (mine[k][1] if example < len(targets) else "")


def test_written_blocks_are_linear(spark):
    """A conversation's text is written once, however many examples it has."""
    rows = [r for r in chat_rows() if r[0] == 5]
    path = scratch_path(spark, "examples")
    prefix_targets.write_examples(spark.createDataFrame(rows, CHAT_SCHEMA).repartition(3), path, 2000)
    blocks = spark.read.parquet(path)
    assert blocks.agg(F.sum(F.length("text"))).first()[0] == sum(len(f"<turn>{r[2]}\n{r[3]}</turn>\n") for r in rows)
    assert blocks.agg(F.max(F.length("text"))).first()[0] < 2000 + 300
    assert blocks.select("piece").distinct().count() == blocks.count() > 5


def test_no_conversations(spark):
    assert prefix_targets.round_trip(spark.createDataFrame([], CHAT_SCHEMA)).count() == 0


def test_op11_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, k, role, queries.PROBE_TEXT) for k, role in enumerate(("user", "assistant"))]
    df = queries.op11_prefix_targets(spark, SF)
    assert df.dtypes == [("conv_id", "bigint"), ("n_turns", "bigint"), ("turns_sha256", "string"), ("loss_chars", "bigint"), ("loss_sha256", "string"), ("formatted_chars", "bigint")]
    assert as_dict(df) == chat_brute(rows)


# --- token alignment ---

LIBRARY = Tokenizer.from_file(BYTE)
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PIECE)
RANKS = RankEncoder(BYTE, plain=True)
SPECIAL_RANKS = RankEncoder(BYTE)


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=st.sampled_from(list("abTHE's.,!12 \n\t\x1c\xa0é́ß日<|>endoftextİΣ▁ ")), max_size=60)))
def test_rank_encoder_gives_the_library_ids(text):
    assert RANKS.ids(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    text += "<|endoftext|>" + text
    assert SPECIAL_RANKS.ids(text).tolist() == WITH_SPECIAL.encode(text, add_special_tokens=False).ids


WITH_SPECIAL = Tokenizer.from_file(BYTE)


@pytest.mark.parametrize("text", ["x" * 300_000, " " * 1_200_000 + "b", "日" * 200_000, "\n" * 300_000])
def test_rank_encoder_on_very_long_runs(text):
    ids = RANKS.ids(text)
    assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert b"".join(RANKS.tokens[i] for i in ids.tolist()).decode() == text


def token_ends(text):
    """(id, end) of the tokens of both sides, or none."""
    if not text:
        return [], []
    a, b = [], []
    for out, ids, raw in ((a, LIBRARY.encode(" " + text, add_special_tokens=False).ids, RANKS.tokens), (b, PIECES.encode(text), None)):
        spelled = b""
        for i in ids:
            if raw is None:
                piece = PIECES.id_to_piece(i)
                spelled += bytes([int(piece[3:5], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode()
            else:
                spelled += raw[i]
            out.append((i, len(spelled)))
        if spelled != (" " + text).encode():
            return [], []
    return a, b


def alignment_brute(rows):
    per_doc, counts = [], Counter()
    for doc, text in rows:
        a, b = token_ends(text)
        cuts = sorted({e for _, e in a} & {e for _, e in b})
        groups, before = [], 0
        for cut in cuts:
            groups.append(",".join(str(i) for i, e in a if before < e <= cut) + "|" + ",".join(str(i) for i, e in b if before < e <= cut))
            before = cut
        ends = defaultdict(list)
        for i, e in b:
            ends[e].append(i)
        links = [(i, j) for i, e in a for j in ends[e]]
        counts.update(links)
        per_doc.append((doc, a, b, groups, links))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return sorted(
        (
            (doc is None, doc or 0, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
             sha(";".join(groups)) if a else "")
            for doc, a, b, groups, links in per_doc
        )
    )


def aligned(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((r[0] is None, r[0] or 0, *r[1:]) for r in df.select(*names).collect())


@pytest.fixture(scope="module")
def short_docs(docs):
    """The awkward rows, with their long texts shortened for the quadratic brute force."""
    more = docs.sparkSession.createDataFrame(
        [(900, "a▁b literal"), (901, "<s> <|endoftext|> <0x41>"), (902, "  two  spaces "), (903, "\x00\t\r"), (904, "a" * 200 + " " * 90)], "doc_id long, text string"
    )
    return docs.withColumn("text", F.substring("text", 1, 2500)).unionByName(more, allowMissingColumns=True)


@pytest.mark.parametrize("frequent", [0, 3, 40, 1 << 19])
def test_alignment(short_docs, frequent):
    expected = alignment_brute(cases.rows_of(short_docs))
    assert sum(r[-1] == "" for r in expected) >= 3
    assert aligned(token_alignment.align(short_docs, BYTE, PIECE, frequent)) == expected


def test_alignment_of_a_long_text_and_of_none(spark):
    text = cases.words(random.Random(8), 60_000)
    row = token_alignment.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), BYTE, PIECE).first()
    a, b = token_ends(text)
    assert (row["n_a"], row["n_b"], row["n_links"]) == (len(a), len(b), len({e for _, e in a} & {e for _, e in b}))
    assert token_alignment.align(cases.no_documents(spark), BYTE, PIECE).count() == 0


def test_op12_query(spark):
    df = queries.op12_token_alignment(spark, SF)
    assert aligned(df) == alignment_brute([tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()])
    assert {t for _, t in df.dtypes} == {"bigint", "string"}


# --- lexical search ---

ITEM_SCHEMA = "item_id long, text string, score long, rank int, item int"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def search_brute(docs, items, most=10):
    counted = [(doc, Counter(words_of(text))) for doc, text in docs]
    counted = [(doc, c) for doc, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(words_of(text))
    out = []
    for item, terms in wanted.items():
        found = []
        for doc, c in counted:
            size = sum(c.values())
            m = 100 - 90 + (90 * size * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(found)[:most], 1):
            out.append((item, rank, None if none else doc, -score))
    return Counter(out)


@pytest.mark.parametrize(("most", "block"), [(10, 1 << 23), (2, 150)])
def test_search(spark, docs, most, block):
    texts = cases.texts()
    rows = [(0, "ONE two, the very same line"), (1, texts[5][:300]), (2, None), (3, ""), (4, "日本語のテキスト é"), (5, " ".join(texts[10].split()[75:95])), (5, "tail café"), (None, "very same"), (6, "nowhereatall"), (7, "e the one"), (7, "e the one")]
    items = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], ITEM_SCHEMA)
    found = reversed_search.search(docs, items, most, block)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    expected = search_brute(cases.rows_of(docs), rows, most)
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert max(expected.values()) == 1 and sum(expected.values()) > 10


def test_search_of_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "one", 1, 2, 3)], ITEM_SCHEMA)
    assert reversed_search.search(cases.no_documents(spark), items).count() == 0
    assert reversed_search.search(docs, spark.createDataFrame([], ITEM_SCHEMA)).count() == 0


def test_scores_add_up_without_rounding():
    index = reversed_search.Index(["a b c", "a", "c"])
    import numpy as np

    big = np.array([2**53 + 1, 2**55 + 3, 5], dtype=np.int64)
    assert reversed_search.spread(big, np.array([0, 1, 2]), index).tolist() == [2**53 + 2**55 + 9, 2**53 + 1, 5]


def test_op13_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert Counter(tuple(r) for r in queries.op13_reversed_search(spark, SF).collect()) == search_brute(docs, items)
