r"""Chat formatting: every assistant turn becomes an example of its own.

An example holds all turns before its assistant turn as context and that turn as
its target; only the target's text is trainable. Turns that follow the last
assistant turn make one more example with nothing trainable, so that no turn is
lost.

Template: ``<turn>ROLE`` newline ``TEXT</turn>`` newline. In roles and texts a
backslash is put before every backslash and before ``<turn>`` and ``</turn>``,
in roles before newlines too; dropping the backslash of each pair gives the
original back. The end mark is not trainable.

All examples of a conversation are prefixes of one formatted text, so that text
is written once, in blocks of at most ``BLOCK_CHARS`` characters and one turn
more, with a mark for each target (its number, where the example ends, which
characters are trainable). Disk stays linear in the input; ``examples`` explodes
the marks while it reads, and a block that lies whole before a target is
repeated for it as one more piece.

Scale: turns are sorted by sampled ranges of (conversation, turn, ...), so a
conversation with very many turns is spread over tasks, each of which streams
and holds one block; numbers carry over from task to task through at most two
narrow rows a task. Only ``digests`` takes a conversation through one task, as a
SHA-256 is one chain; it streams pieces and keeps two hash states.

Edge cases: null texts and roles are empty; a null ``conv_id`` is a conversation
of its own; null turns come first; turns of one number go by role, then by a
hash of the text, and repeated rows are turns of their own; an empty assistant
text is an example with nothing trainable; very long texts are one block; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brisa.llm import store
from brisa.session import scratch_path

BLOCK_CHARS = 1 << 20
TARGET_ROLE = "assistant"

_BLOCK = "part int, run int, conv_id long, block int, followed boolean, targets long, text string, marks array<struct<target:long,end:int,loss_start:int,loss_end:int>>"
FILES = "conv_id long, piece long, followed boolean, text string, marks array<struct<example:long,end:int,loss_start:int,loss_end:int,trainable:boolean>>"
_READ = "conv_id long, example long, piece long, chars long, reply string, n_turns long, turns string"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_ARROW_BLOCK = pa.schema(
    [
        ("part", pa.int32()),
        ("run", pa.int32()),
        ("conv_id", pa.int64()),
        ("block", pa.int32()),
        ("followed", pa.bool_()),
        ("targets", pa.int64()),
        ("text", pa.string()),
        ("marks", pa.list_(pa.struct([("target", pa.int64()), ("end", pa.int32()), ("loss_start", pa.int32()), ("loss_end", pa.int32())]))),
    ]
)
_TOKEN = re.compile(r"\\.|<turn>|</turn>\n", re.DOTALL)
_ROLE = re.compile(r"((?:\\.|[^\\\n])*)\n", re.DOTALL)
_PAIR = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: Column, newlines: bool = False) -> Column:
    return F.regexp_replace(text, r"(\\|</?turn>|\n)" if newlines else r"(\\|</?turn>)", r"\\$1")


def unescaped(text: str) -> str:
    return _PAIR.sub(r"\1", text)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of each formatted turn, unescaped."""
    out, start = [], 0
    for m in _TOKEN.finditer(text):
        if m.group() == "<turn>":
            start = m.end()
        elif m.group() == "</turn>\n":
            role = _ROLE.match(text, start, m.start())
            out.append((unescaped(role.group(1)), unescaped(text[role.end() : m.start()])))
    return out


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted turns of a task joined into blocks; a block closes when a turn comes that is no longer its own."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    conv, run, block, target = None, -1, 0, 0
    held: list[str] = []
    marks: list[dict] = []
    size = 0

    def closed(followed: bool) -> pa.RecordBatch:
        row = {"part": part, "run": run, "conv_id": conv, "block": block, "followed": followed, "targets": target, "text": "".join(held), "marks": marks}
        return pa.RecordBatch.from_pylist([row], schema=_ARROW_BLOCK)

    for batch in batches:
        for row in batch.to_pylist():
            other = run < 0 or row["conv_id"] != conv
            if held and (other or size >= most):
                yield closed(not other)
                block, held, marks, size = block + 1, [], [], 0
            if other:
                conv, run, block, target = row["conv_id"], run + 1, 0, 0
            turn = [row["head"], row["body"], row["tail"]]
            if row["target"]:
                start = size + len(turn[0])
                marks.append({"target": target, "end": size + sum(map(len, turn)), "loss_start": start, "loss_end": start + len(turn[1])})
                target += 1
            held += turn
            size += sum(map(len, turn))
    if held:
        yield closed(False)


def write_examples(
    turns: DataFrame,
    path: str,
    block_chars: int = BLOCK_CHARS,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> None:
    """Format conversations and write blocks with the marks of their examples (``FILES``) to ``path``."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    role, text = store.as_text(role_col), store.as_text(text_col)
    parts = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        role.alias("role"),
        F.xxhash64(text).alias("draw"),
        F.monotonically_increasing_id().alias("seq"),
        F.concat(F.lit("<turn>"), escaped(role, newlines=True), F.lit("\n")).alias("head"),
        escaped(text).alias("body"),
        F.lit("</turn>\n").alias("tail"),
        (role == TARGET_ROLE).alias("target"),
    )
    order = ["conv_id", "turn", "role", "draw", "seq"]
    ordered = parts.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv_id", "head", "body", "tail", "target")
    blocks = store.materialise(ordered.mapInArrow(lambda batches: _blocks(batches, block_chars), _BLOCK), "chat_blocks")
    runs = blocks.groupBy("part", "run", "conv_id").agg(F.count("*").alias("blocks"), F.max("targets").alias("targets"))
    along = Window.partitionBy("conv_id").orderBy("part")
    reach = runs.select(
        F.col("part").alias("r_part"),
        F.col("run").alias("r_run"),
        (F.sum("blocks").over(along) - F.col("blocks")).alias("blocks_before"),
        (F.sum("targets").over(along) - F.col("targets")).alias("targets_before"),
        F.lead("part").over(along).isNotNull().alias("goes_on"),
    )
    # Only a task's first and last conversation reach over to other tasks: at most two rows a task.
    crossing = F.broadcast(reach.filter((F.col("blocks_before") > 0) | F.col("goes_on")))
    before = F.coalesce("targets_before", F.lit(0))
    numbered = blocks.join(crossing, (F.col("part") == F.col("r_part")) & (F.col("run") == F.col("r_run")), "left").select(
        "conv_id",
        (F.col("block") + F.coalesce("blocks_before", F.lit(0))).alias("piece"),
        (F.col("followed") | F.coalesce("goes_on", F.lit(False))).alias("followed"),
        "text",
        F.transform(
            "marks", lambda m: F.struct((m["target"] + before).alias("example"), m["end"], m["loss_start"], m["loss_end"], F.lit(True).alias("trainable"))
        ).alias("marks"),
        (F.col("targets") + before).alias("next"),
        F.length("text").alias("chars"),
    )
    # Turns after the last target.
    rest = F.struct(
        F.col("next").alias("example"), F.col("chars").alias("end"), F.col("chars").alias("loss_start"), F.col("chars").alias("loss_end"), F.lit(False).alias("trainable")
    )
    ended = F.when(F.size("marks") > 0, F.element_at("marks", -1)["end"]).otherwise(0)
    marks = F.when(~F.col("followed") & (ended < F.col("chars")), F.concat("marks", F.array(rest))).otherwise(F.col("marks"))
    numbered.select("conv_id", "piece", "followed", "text", marks.alias("marks")).write.parquet(path)


def examples(spark: SparkSession, path: str) -> DataFrame:
    """The examples in written blocks, one row per example and piece.

    ``conv_id, example, piece, text, loss_start, loss_end, trainable, last``: an
    example's text is that of its pieces in order. The trainable characters
    ``[loss_start, loss_end)`` lie in its highest piece, where ``trainable`` says
    whether it has a target; both are null in pieces before. ``last`` marks the
    pieces of a conversation's longest example, which holds all its turns.
    """
    files = spark.read.schema(FILES).parquet(path)
    marked = files.select("conv_id", "piece", "followed", "text", F.size("marks").alias("n"), F.posexplode("marks").alias("at", "mark"))
    own = marked.select(
        "conv_id",
        F.col("mark.example").alias("example"),
        "piece",
        F.substring("text", F.lit(1), F.col("mark.end")).alias("text"),
        F.col("mark.loss_start").alias("loss_start"),
        F.col("mark.loss_end").alias("loss_end"),
        F.col("mark.trainable").alias("trainable"),
        (~F.col("followed") & (F.col("at") == F.col("n") - 1)).alias("last"),
    )
    wanted = own.filter(F.col("piece") > 0).select(
        "conv_id", "example", "last", F.explode(F.sequence(F.lit(0).cast("long"), F.col("piece") - 1)).alias("piece")
    )
    whole = files.filter("followed").select(F.col("conv_id").alias("w_conv"), F.col("piece").alias("w_piece"), "text")
    earlier = wanted.join(whole, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("piece") == F.col("w_piece"))).select(
        "conv_id",
        "example",
        "piece",
        "text",
        F.lit(None).cast("int").alias("loss_start"),
        F.lit(None).cast("int").alias("loss_end"),
        F.lit(None).cast("boolean").alias("trainable"),
        "last",
    )
    return own.unionByName(earlier)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        replies = [None if r is None else unescaped(r) for r in batch.column(4).to_pylist()]
        turns = [None if t is None else parse(t) for t in batch.column(5).to_pylist()]
        joined = [None if t is None else "".join(f"{role}\n{text}\n" for role, text in t) for t in turns]
        counts = [0 if t is None else len(t) for t in turns]
        columns = [*batch.columns[:4], pa.array(replies, pa.string()), pa.array(counts, pa.int64()), pa.array(joined, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "example", "piece", "chars", "reply", "n_turns", "turns"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv: tuple | None = None
    state: list = []

    def row() -> pa.RecordBatch:
        n_turns, turns, loss_chars, loss, chars = state
        values = [conv[0], n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    for batch in batches:
        for r in batch.to_pylist():
            if conv != (r["conv_id"],):
                if conv is not None:
                    yield row()
                conv, state = (r["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[4] += r["chars"]
            if r["reply"] is not None:
                state[2] += len(r["reply"])
                state[3].update(r["reply"].encode())
            if r["turns"] is not None:
                state[0] += r["n_turns"]
                state[1].update(r["turns"].encode())
    if conv is not None:
        yield row()


def digests(found: DataFrame) -> DataFrame:
    """Per conversation, from its examples: turns, their digest, trainable characters, their digest, characters of all examples."""
    pieces = found.select(
        "conv_id",
        "example",
        "piece",
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("trainable"), F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))).alias("reply"),
        F.when(F.col("last"), F.col("text")).alias("whole"),
    )
    read = pieces.mapInArrow(_read, _READ)
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "example", "piece").mapInArrow(_hashed, DIGESTS)


def round_trip(turns: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Write the examples of ``turns`` and digest what the files give back."""
    path = scratch_path(turns.sparkSession, "chat_examples")
    write_examples(turns, path, block_chars)
    return digests(examples(turns.sparkSession, path))
