"""Toxicity scores from averaged subword embeddings and a linear softmax.

A word is a bag: its character n-grams with end marks, hashed into a table of
embeddings, plus the word itself. A misspelling that was never seen still
shares most of its n-grams with the word it bends. A window of consecutive
words is the mean of its words' means; a two-class softmax reads the window;
a document is as toxic as its most toxic window, so a short insult in a long
text is not averaged away. Windows cover the whole text, so a long text is read
to its end; of windows that score alike the first counts. By default a window
is one word: that cuts no insult at a border, and in three-fold
cross-validation over the rows of sf0.1 that may be learnt from it found 0.92
of the toxic rows at precision 0.93, windows of four words 0.75 at 0.87.

Training is joint: embeddings, softmax weights and bias follow the gradient of
the documents' log loss together, full batch, in numpy in one task over a
bounded sample of labelled rows (``Settings.positives`` and
``Settings.negatives`` documents, the smallest by a hash of the id). For two
classes the softmax depends only on the difference of its weight rows, so a
trained model folds into one number per bucket, which is all that scoring
ships to the executors (fixed size).

Scale: scoring is map-only. Distinct words are hashed once per worker and kept
in a bounded cache.

Edge cases: an empty documents table gives no rows; a null or empty text (or
one of white space) has no window and scores the bias alone; rows that repeat are scored alike; a label row that is
null, or whose document does not exist, teaches nothing; several label rows of
one id count as toxic if any is. Without any usable label the score is the
prior 0. Labels, languages, sources and ids are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm import store

SCHEMA = "doc_id long, score double"
_SCORES_KEPT = 300_000
PUNCTUATION = ".,;:!?\"'()[]{}|<>*_-"


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 8
    shortest: int = 3
    longest: int = 7
    window: int = 1
    epochs: int = 80
    warm: int = 30
    rate: float = 0.1
    decay: float = 1e-5
    # Bound of the labelled sample that training reads.
    positives: int = 1000
    negatives: int = 2000
    seed: int = 13


def grams(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every word, and the words' indices, by word."""
    raw = [f"<{w.strip(PUNCTUATION) or w}>".encode() for w in words]
    size = np.array([len(x) for x in raw], dtype=np.int64)
    flat = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(raw)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(flat))  # bytes to the end of the word
    prime = np.uint64(0x100000001B3)
    whole = np.zeros(len(raw), dtype=np.uint64)
    if len(raw):
        place = (np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)).astype(np.uint64)
        whole = np.add.reduceat(_mix(flat + (place << np.uint64(8))), np.cumsum(size) - size)
    found, owners = [_mix(whole)], [np.arange(len(raw))]
    h = np.full(len(flat), 0xCBF29CE484222325, dtype=np.uint64)
    for n in range(1, s.longest + 1):
        if len(flat) < n:
            break
        h = (h[: len(flat) - n + 1] ^ flat[n - 1 :]) * prime
        if n >= s.shortest:
            ok = left[: len(h)] >= n
            found.append(_mix(h[ok] + np.uint64(n)))
            owners.append(word[: len(h)][ok])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(found) % np.uint64(s.buckets)).astype(np.int64)[order], owner[order]


def _grams_of(words: list[str], s: Settings, chunk: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """``grams`` of a long list, a chunk at a time, in 32-bit integers."""
    parts = []
    for at in range(0, len(words), chunk):
        bucket, owner = grams(words[at : at + chunk], s)
        parts.append((bucket.astype(np.int32), (owner + at).astype(np.int32)))
    return np.concatenate([b for b, _ in parts]), np.concatenate([o for _, o in parts])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_scores(words: list[str], table: np.ndarray, s: Settings) -> np.ndarray:
    """Mean bucket score of each word."""
    if not words:
        return np.zeros(0)
    bucket, owner = grams(words, s)
    n = np.bincount(owner, minlength=len(words))
    return np.bincount(owner, weights=table[bucket], minlength=len(words)) / n


def window_starts(n_words: int, window: int) -> np.ndarray:
    return np.arange(0, n_words, window)


@dataclass(frozen=True)
class Model:
    table: np.ndarray  # score of each bucket
    bias: float
    settings: Settings

    def logit(self, scores: np.ndarray) -> float:
        """Of a document, from its words' scores in order."""
        if not len(scores):
            return self.bias
        starts = window_starts(len(scores), self.settings.window)
        sums = np.add.reduceat(scores, starts)
        return float((sums / np.diff(np.append(starts, len(scores)))).max()) + self.bias


def train(texts: list[str], labels: list[int], s: Settings) -> Model:
    """Joint full-batch training of embeddings and softmax (Adam)."""
    y = np.array(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        prior = 0.0 if not len(y) else y[0]
        return Model(np.zeros(s.buckets), -20.0 if prior == 0 else 20.0, s)
    vocabulary: dict[str, int] = {}
    word, doc_of, win_of, wins = [], [], [], 0
    for d, text in enumerate(texts):
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in text.lower().split()] or [vocabulary.setdefault("", len(vocabulary))]
        word.append(np.array(ids, dtype=np.int64))
        k = -(-len(ids) // s.window)
        win_of.append(wins + np.arange(len(ids)) // s.window)
        doc_of += [d] * k
        wins += k
    word, win_of, doc_of = (np.concatenate(x).astype(np.int32) for x in (word, win_of, [doc_of]))
    bucket, owner = _grams_of(list(vocabulary), s)
    per_word = np.bincount(owner, minlength=len(vocabulary)).astype(np.float32)
    per_win = np.bincount(win_of, minlength=wins).astype(np.float32)
    # Words hold consecutive n-grams and windows consecutive words.
    gram_at = np.cumsum(per_word, dtype=np.int64) - per_word.astype(np.int64)
    word_at = np.cumsum(per_win, dtype=np.int64) - per_win.astype(np.int64)
    first_win = np.searchsorted(doc_of, np.arange(len(texts)))
    rng = np.random.default_rng(s.seed)
    e = rng.uniform(-1.0, 1.0, (s.buckets, s.dim)) / s.dim
    u = rng.uniform(-0.1, 0.1, s.dim)
    b = np.array([np.log(y.mean() / (1 - y.mean()))])
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (e, u, b)]
    for step in range(1, s.epochs + 1):
        table = (e @ u).astype(np.float32)
        w_score = np.add.reduceat(table[bucket], gram_at) / per_word
        k_score = np.add.reduceat(w_score[word], word_at) / per_win
        if step <= s.warm:
            # Warm start: every window counts, the higher ones more and more.
            weight = np.exp(np.minimum(30.0, 8.0 * step / s.warm * (k_score - np.maximum.reduceat(k_score, first_win)[doc_of])))
            weight /= np.add.reduceat(weight, first_win)[doc_of]
            seen = np.add.reduceat(weight * k_score, first_win)
            miss = (1 / (1 + np.exp(-(seen + b[0]))) - y) / len(y)
            g_win = (weight * miss[doc_of] / per_win).astype(np.float32)
            g_word = np.bincount(word, weights=g_win[win_of], minlength=len(per_word)) / per_word
            g_bucket = np.bincount(bucket, weights=g_word[owner], minlength=s.buckets)
        else:
            top = np.maximum.reduceat(k_score, first_win)
            # Of equal windows the first.
            best = np.full(len(y), wins)
            hit = np.flatnonzero(k_score == top[doc_of])
            np.minimum.at(best, doc_of[hit], hit)
            miss = (1 / (1 + np.exp(-(top + b[0]))) - y) / len(y)
            # The gradient passes through each document's best window alone: its words, then their n-grams.
            words_in, of = _spans(word_at[best], per_win[best].astype(np.int64))
            grams_in, in_word = _spans(gram_at[word[words_in]], per_word[word[words_in]].astype(np.int64))
            g_word = (miss / per_win[best])[of] / per_word[word[words_in]]
            g_bucket = np.bincount(bucket[grams_in], weights=g_word[in_word], minlength=s.buckets)
        grads = (np.outer(g_bucket, u) + s.decay * e, e.T @ g_bucket + s.decay * u, np.array([miss.sum()]))
        for x, g, (m, v) in zip((e, u, b), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Model(e @ u, float(b[0]), s)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the runs ``starts[i] .. starts[i] + sizes[i]``, and each index's run."""
    run = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(run)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes), run


def held_out(id_column: Column) -> Column:
    """Rows that training never reads: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from the labelled rows that are not held out."""
    s = settings or Settings()
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    read = store.documents(docs, id_col, text_col)
    known = known.join(read.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("draw", F.xxhash64(F.lit(s.seed), "doc_id"))
    sample = known.filter("toxic = 1").orderBy("draw").limit(s.positives).unionByName(
        known.filter("toxic = 0").orderBy("draw").limit(s.negatives)
    )
    # The sample is bounded by its two limits, so it may be broadcast, and its texts be one task's input.
    rows = read.join(F.broadcast(store.materialise(sample, "labelled")), "doc_id").select("draw", "text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for batch in batches:
            texts += batch.column(1).to_pylist()
            marks += batch.column(2).to_pylist()
        model = train(texts, marks, s)
        yield pa.RecordBatch.from_pydict({"table": pa.array([model.table.astype("<f8").tobytes()], pa.binary()), "bias": pa.array([model.bias], pa.float64())})

    # Training runs in a task, whose memory is given back, rather than in the driver.
    trained = rows.repartition(1).sortWithinPartitions("draw", "text").mapInArrow(run, "table binary, bias double").collect()
    if not trained:
        return train([], [], s)
    return Model(np.frombuffer(trained[0]["table"], "<f8"), trained[0]["bias"], s)


class _Scorer:
    """Scores of texts under a model, with the scores of distinct words kept."""

    def __init__(self, table: np.ndarray, bias: float, s: Settings):
        self.model = Model(table.astype(np.float64), bias, s)
        self.kept: dict[str, float] = {}

    def __call__(self, texts: pa.Array) -> np.ndarray:
        out, at = [], 0
        while at < len(texts):
            bags, held = [], 0
            while at < len(texts) and held < 1 << 17:
                bags.append(texts[at].as_py().lower().split())
                held += len(bags[-1])
                at += 1
            words = set().union(*bags)
            if len(self.kept) + len(words) > _SCORES_KEPT:
                self.kept.clear()
            new = [w for w in words if w not in self.kept]
            self.kept.update(zip(new, word_scores(new, self.model.table, self.model.settings).tolist(), strict=True))
            out += [self.model.logit(np.array(list(map(self.kept.__getitem__, bag)))) for bag in bags]
        return 1 / (1 + np.exp(-np.clip(np.array(out, dtype=np.float64), -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row."""
    folded = model.table.astype(np.float32), model.bias, model.settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(*folded)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer(batch.column(1)), pa.float64())], names=["doc_id", "score"])

    return store.documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def drop_toxic(docs: DataFrame, model: Model, reject_from: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``reject_from``, with all their columns; no shuffle."""
    folded = model.table.astype(np.float32), model.bias, model.settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(*folded)
        for batch in batches:
            clean = scorer(batch.column(batch.num_columns - 1)) < reject_from
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(batch.schema)[:-1])).filter(pa.array(clean))

    names = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names)
    text = store.as_text(names[docs.columns.index(text_col)])
    return inner.select(*names, text.alias("read")).mapInArrow(run, inner.schema).toDF(*docs.columns)
