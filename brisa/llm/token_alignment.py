"""Which tokens of two tokenizers end together, and how often each id pair does.

Both vocabularies cut one byte string, a space and the text. Where a token of A
and a token of B end at the same byte the string is cut into groups, and the two
tokens are linked. Each link is weighed by how many links of the corpus join
the same two ids.

Inside a task everything is Arrow: the ids of a slice of documents are list
arrays; flattening them with their parent indices gives one row per token; token
lengths, summed along the column less the sum at the document's start, give the
end of each token; ``document << 40 | end`` is the key on which an Acero hash
join finds the links; ``Table.group_by`` counts id pairs, and Spark adds up the
partial counts.

Three passes. The first encodes and writes each document's links (ids only; no
text travels further). The second counts pairs: partial counts per task, one
shuffle of distinct pairs. The third looks the counts up: the ``frequent``
commonest pairs (a fixed number, 24 bytes each) are broadcast and settle all of
their links inside the task; links of the other pairs go through a shuffle join
on the pair, where no pair can be hot, as each occurs at most
``links / frequent`` times. Documents without such links never shuffle.

Edge cases: null and empty texts have no tokens, nor have texts whose tokens of
A or B do not spell the space and the text (a literal U+2581, say): zeros and an
empty digest. Rows that repeat are documents of their own, a null ``doc_id``
stays null; tied counts are all the highest; very long texts are one slice, of
memory in proportion to their length; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm import store
from brisa.llm.wordpieces import RankEncoder

ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a binary, b binary"
COUNTED = "a int, b int, n long"
WEIGHED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "n_best long, count_sum long, rest array<struct<a:int,b:int,links:long>>"
)
SLICE_CHARS = 1 << 20
FREQUENT = 1 << 19
PAIRS_HELD = 1 << 20
END_BITS = 40


class Side:
    """One tokenizer: the id lists of texts, and the bytes of each id."""

    def __init__(self, encode: Callable[[list[str]], list], tokens: list[bytes]):
        self._encode = encode
        self.tokens = pa.array(tokens, pa.binary())
        self.lengths = pc.binary_length(self.tokens).cast(pa.int64())

    def lists(self, texts: list[str]) -> pa.ListArray:
        each = [np.asarray(x, dtype=np.int32) for x in self._encode(texts)]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, dtype=np.int32), *each]))


def byte_level_side(path: str) -> Side:
    """A byte-level vocabulary; a text is encoded with a space before it, an empty one has no tokens."""
    encoder = RankEncoder(path, plain=True)
    return Side(lambda texts: [encoder.ids(" " + t) if t else [] for t in texts], encoder.tokens)


def piece_side(path: str) -> Side:
    """A sentencepiece vocabulary, which puts the space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Side(lambda texts: model.encode(texts, num_threads=1), tokens)


_SIDES: dict[tuple, Side] = {}


def _side(make: Callable[[str], Side], path: str) -> Side:
    """One encoder per Python worker and vocabulary."""
    key = (make.__qualname__, path)
    if key not in _SIDES:
        _SIDES[key] = make(path)
    return _SIDES[key]


def _spelled(lists: pa.ListArray, side: Side) -> pa.Array:
    """The joined bytes of each list of ids."""
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, side.tokens.take(lists.values)), b"")


def token_ends(lists: pa.ListArray, lengths: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Document of each token, and the byte at which it ends in it: sums along the column, less the sum before the document."""
    parents = pc.list_parent_indices(lists)
    each = lengths.take(pc.list_flatten(lists))
    if not len(each):
        return parents.cast(pa.int64()), each
    running = pc.cumulative_sum(each)
    padded = pa.concat_arrays([pa.array([0], pa.int64()), running])
    before = padded.take(lists.offsets[: len(lists)])
    return parents.cast(pa.int64()), pc.subtract(running, before.take(parents))


def _keyed(lists: pa.ListArray, side: Side, name: str) -> pa.Table:
    parents, ends = token_ends(lists, side.lengths)
    key = pc.bit_wise_or(pc.shift_left(parents, pa.scalar(END_BITS, pa.int64())), ends)
    return pa.table({"key": key, name: pc.list_flatten(lists)})


def linked(a: pa.Table, b: pa.Table) -> pa.Table:
    """Links ``key, a, b`` in the order of the keys: tokens that end together."""
    found = a.join(b, keys="key", join_type="inner", use_threads=False).combine_chunks()
    return found.sort_by([("key", "ascending"), ("a", "ascending"), ("b", "ascending")])


def _digests(a: pa.Table, b: pa.Table, cuts: np.ndarray, rows: int, labels: pa.Array) -> list[str]:
    """Hex digest of the groups of each document, '' where it has none.

    A token belongs to the group that the first cut at or after its end closes.
    The tokens of both sides in order of (group, side) are taken from a table of
    rendered ids, each with the separator that follows it.
    """
    keys = [t.column("key").to_numpy() for t in (a, b)]
    group = [np.searchsorted(cuts, k) for k in keys]
    ids = [t.column(c).to_numpy() for t, c in ((a, "a"), (b, "b"))]
    place, size = [], len(labels) // 5
    for side in (0, 1):
        ends = np.ones(len(group[side]), dtype=bool)
        ends[:-1] = group[side][1:] != group[side][:-1]
        if side == 0:
            place.append(ids[0] + np.where(ends, size, 0))
        else:
            last = np.ones(len(ends), dtype=bool)
            last[:-1] = (keys[1][1:] >> END_BITS) != (keys[1][:-1] >> END_BITS)
            place.append(ids[1] + np.where(last, 4 * size, np.where(ends, 3 * size, 2 * size)))
    order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
    shown = labels.take(pa.array(np.concatenate(place)[order]))
    per_doc = sum(np.bincount(k >> END_BITS, minlength=rows) for k in keys)
    offsets = np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32)
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, shown), b"")
    return [hashlib.sha256(x.as_py()).hexdigest() if n else "" for x, n in zip(joined, per_doc, strict=True)]


def _labels(size: int) -> pa.Array:
    """Each id as text five times: inside and at the end of a group of A, inside, at the end and at the very end of one of B."""
    return pa.array([str(i).encode() + s for s in (b",", b"|", b",", b";", b"") for i in range(size)], pa.binary())


def align_slice(texts: list[str], a_side: Side, b_side: Side, labels: pa.Array) -> dict[str, pa.Array]:
    """Columns of ``ALIGNED`` (but for the ids) for some texts."""
    a_lists, b_lists = a_side.lists(texts), b_side.lists(texts)
    wanted = pa.array([(" " + t).encode() if t else b"" for t in texts], pa.binary())
    right = pc.and_(pc.equal(_spelled(a_lists, a_side), wanted), pc.equal(_spelled(b_lists, b_side), wanted)).to_pylist()
    if not all(right):
        kept = [t if ok else "" for t, ok in zip(texts, right, strict=True)]
        a_lists, b_lists = a_side.lists(kept), b_side.lists(kept)
    a, b = _keyed(a_lists, a_side, "a"), _keyed(b_lists, b_side, "b")
    links = linked(a, b)
    keys = links.column("key").to_numpy()
    cuts = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    rows = len(texts)
    n_links = np.bincount(keys >> END_BITS, minlength=rows)
    offsets = np.concatenate([[0], np.cumsum(n_links)]).astype(np.int32)
    return {
        "n_a": pc.list_value_length(a_lists).cast(pa.int64()),
        "n_b": pc.list_value_length(b_lists).cast(pa.int64()),
        "n_groups": pa.array(np.bincount(cuts >> END_BITS, minlength=rows), pa.int64()),
        "n_links": pa.array(n_links, pa.int64()),
        "groups_sha256": pa.array(_digests(a, b, cuts, rows, labels), pa.string()),
        "a": _packed(links.column("a"), offsets),
        "b": _packed(links.column("b"), offsets),
    }


def _packed(ids: pa.ChunkedArray, offsets: np.ndarray) -> pa.Array:
    """The ids of each document as bytes, 16 or 32 bits an id: in Spark's rows these cost far less than arrays."""
    values = ids.to_numpy()
    values = values.astype("<u2" if not len(values) or values.max() < 1 << 16 else "<u4")
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _ids(packed: pa.Array, n_links: pa.Array) -> pa.ListArray:
    """The inverse of ``_packed``, for rows that need not agree in their width."""
    each = [np.frombuffer(x, f"<u{len(x) // n}") if n else () for x, n in zip(packed.to_pylist(), n_links.to_pylist(), strict=True)]
    offsets = np.concatenate([[0], np.cumsum(n_links.to_numpy())]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int32), *each]).astype(np.int32))


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of a million characters, or one longer text."""
    held: list[str] = []
    first = chars = 0
    for i, text in enumerate(texts):
        held.append(text.as_py())
        chars += len(held[-1])
        if chars >= SLICE_CHARS:
            yield first, held
            first, held, chars = i + 1, [], 0
    if held:
        yield first, held


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: token counts, groups and the linked ids (written, as ``ALIGNED``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = _side(byte_level_side, a_path), _side(piece_side, b_path)
        labels = _labels(max(len(a_side.tokens), len(b_side.tokens)))
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                columns = align_slice(texts, a_side, b_side, labels)
                ids = {"row": pa.array(range(row, row + len(texts)), pa.int64()), "doc_id": batch.column(0).slice(first, len(texts))}
                row += len(texts)
                yield pa.RecordBatch.from_pydict(ids | columns)

    return store.materialise(store.documents(docs, id_col, text_col).mapInArrow(run, ALIGNED), "token_links")


def _merged(tables: list[pa.Table], how: str) -> pa.Table:
    return pa.concat_tables(tables).group_by(["a", "b"], use_threads=False).aggregate([("n", how)]).rename_columns(["a", "b", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How many links of the corpus hold each id pair: ``a, b, n``; partial counts per task, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            pairs = pa.table({c: pc.list_flatten(_ids(batch.column(c), batch.column("n_links"))) for c in ("a", "b")})
            counts = pairs.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["a", "b", "n"])
            held.append(counts)
            rows += len(counts)
            if rows > PAIRS_HELD:
                held = [_merged(held, "sum")]
                rows = len(held[0])
                if rows > PAIRS_HELD // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from _merged(held, "sum").to_batches()

    return aligned.select("a", "b", "n_links").mapInArrow(run, COUNTED).groupBy("a", "b").agg(F.sum("n").alias("n"))


def align(
    docs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    aligned = links(docs, a_path, b_path, id_col, text_col)
    spark = docs.sparkSession
    counts = pair_counts(aligned)
    # At most one row per id of B.
    highest = counts.groupBy("b").agg(F.max("n").alias("most")).withColumnRenamed("b", "best_of")
    counts = store.materialise(
        counts.join(highest, F.col("b") == F.col("best_of")).select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pair_counts"
    )
    top = counts.orderBy(F.col("n").desc(), "a", "b").limit(frequent).toArrow()
    pair = top.column("a").to_numpy().astype(np.int64) << 32 | top.column("b").to_numpy()
    order = np.argsort(pair)
    known = spark.sparkContext.broadcast((pair[order], top.column("n").to_numpy()[order], top.column("best").to_numpy(zero_copy_only=False)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, numbers, best = known.value
        for batch in batches:
            a_lists, b_lists = (_ids(batch.column(c), batch.column("n_links")) for c in ("a", "b"))
            rows = len(a_lists)
            doc = pc.list_parent_indices(a_lists).to_numpy()
            key = pc.list_flatten(a_lists).to_numpy().astype(np.int64) << 32 | pc.list_flatten(b_lists).to_numpy()
            at = np.minimum(np.searchsorted(pairs, key), max(len(pairs) - 1, 0))
            here = pairs[at] == key if len(pairs) else np.zeros(len(key), dtype=bool)
            total = np.zeros(rows, dtype=np.int64)
            np.add.at(total, doc[here], numbers[at[here]])
            n_best = np.bincount(doc[here][best[at[here]]], minlength=rows)
            rest = pa.table({"doc": doc[~here], "a": (key[~here] >> 32).astype(np.int32), "b": key[~here].astype(np.int32)})
            rest = rest.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "a", "b", "links"])
            rest = rest.sort_by("doc").combine_chunks()
            each = np.bincount(rest.column("doc").to_numpy(), minlength=rows)
            offsets = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
            values = pa.StructArray.from_arrays([_whole(rest, c) for c in ("a", "b", "links")], ["a", "b", "links"])
            kept = [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "rest"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_best, pa.int64()), pa.array(total), pa.ListArray.from_arrays(offsets, values)], names=names
            )

    weighed = store.materialise(aligned.mapInArrow(run, WEIGHED), "weighed_links")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    settled = weighed.filter(F.size("rest") == 0).select(*names)
    open_rows = weighed.filter(F.size("rest") > 0)
    sums = (
        open_rows.select("row", F.inline("rest"))
        .join(counts, ["a", "b"])
        .groupBy("row")
        .agg(F.sum(F.col("n") * F.col("links")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"))
    )
    joined = open_rows.join(sums, "row").withColumns({"n_best": F.col("n_best") + F.col("more_best"), "count_sum": F.col("count_sum") + F.col("more_sum")})
    return settled.unionByName(joined.select(*names))


def _whole(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
