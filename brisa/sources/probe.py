"""First lines and Parquet footers of very many files, read on the executors.

One job lists the files and opens each in a task, so the number of jobs does not
grow with the number of files; what comes back is one short text per distinct
header or type, with the files that share it. Only the first block of a text
file and the footer of a Parquet file are read. Files in a store that pyarrow
cannot open are read through Spark's ``binaryFile`` source in one more job
(whole, one at a time per task).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEEN = "path string, found string, problem string"
FIRST_BLOCK = 1 << 20


def plain(path: str) -> str:
    """A listed path as a literal: glob characters in it are not patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def listed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, length`` of the non-empty files under ``paths``; contents are not read."""
    files = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths))
    return files.filter("length > 0").select("path", "length")


def _open(path: str):
    from urllib.parse import quote

    from pyarrow import fs

    if path.startswith("file:") or path.startswith("/"):
        return fs.LocalFileSystem().open_input_file(re.sub(r"^file:(//)?", "", path))
    scheme, rest = path.split("://", 1)
    store, inner = fs.FileSystem.from_uri(f"{scheme}://{quote(rest)}")
    return store.open_input_file(inner)


def first_line(file, path: str) -> str:
    """The first line that is not blank, of a plain or compressed text file."""
    try:
        codec = pa.Codec.detect(path).name
    except (ValueError, TypeError):
        codec = None
    stream = pa.CompressedInputStream(file, codec) if codec else file
    head = b""
    while True:
        more = stream.read(FIRST_BLOCK)
        head = head.lstrip(b"\r\n") + more
        if not more or re.search(rb"\S[^\r\n]*[\r\n]", head):
            lines = [x for x in re.split(rb"[\r\n]+", head) if x.strip()]
            return lines[0].decode("utf-8", "replace") if lines else ""


def footer_types(file, path: str) -> str:
    """Columns and types in a Parquet footer, as text that is equal for equal types."""
    import pyarrow.parquet as pq

    schema = pq.ParquetFile(file).schema
    columns = (schema.column(i) for i in range(len(schema)))
    return "\n".join(f"{c.path} {c.physical_type} {c.logical_type} {c.max_definition_level} {c.max_repetition_level}" for c in columns)


def _seen(files: DataFrame, look: Callable) -> DataFrame:
    """``path, found, problem`` of each file: what ``look`` sees in it, or why it could not be opened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column("content").to_pylist() if "content" in batch.schema.names else None
            rows = []
            for k, path in enumerate(batch.column("path").to_pylist()):
                try:
                    file = _open(path) if contents is None else pa.BufferReader(contents[k])
                except (OSError, ValueError, NotImplementedError) as e:
                    rows.append((path, None, str(e)[:300]))
                    continue
                with file:
                    rows.append((path, look(file, path), None))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["path", "found", "problem"])

    return files.mapInArrow(run, _SEEN)


def grouped(spark: SparkSession, paths: str | Sequence[str], look: Callable) -> list[tuple[str, list[str]]]:
    """(what ``look`` sees, the files in which it sees that), both sorted.

    The paths end in the driver, as a reader needs them as a list: one string a file.
    """
    seen = _seen(listed(spark, paths), look)
    rows = seen.groupBy("found").agg(F.collect_list("path").alias("paths")).collect()
    out = {r["found"]: sorted(r["paths"]) for r in rows if r["found"] is not None}
    closed = [p for r in rows if r["found"] is None for p in r["paths"]]
    if closed:
        contents = spark.read.format("binaryFile").load([plain(p) for p in closed]).select("path", "content")
        for r in _seen(contents, look).groupBy("found").agg(F.collect_list("path").alias("paths")).collect():
            out[r["found"]] = sorted(out.get(r["found"], []) + r["paths"])
    return sorted(out.items())


def header_groups(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """Column names of headered CSV files, each with the files that share them.

    Names are split by Spark's own reader, once per distinct header.
    """
    groups = grouped(spark, paths, first_line)
    if not groups:
        raise FileNotFoundError(str(paths))
    reader = spark.read.option("header", True).option("inferSchema", False)
    return [(reader.csv(plain(found[0])).columns, [plain(p) for p in found]) for _, found in groups]


def type_groups(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Parquet files grouped by the types in their own footers, with Spark's schema of each group.

    Nanosecond timestamps, which Spark has no type for, are taken as LONG epoch
    nanoseconds. The setting for that is made in a session of its own, so other
    users of ``spark`` do not see it.
    """
    groups = grouped(spark, paths, footer_types)
    if not groups:
        return []
    apart = spark.newSession()
    apart.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return [(apart.read.parquet(plain(found[0])).schema, [plain(p) for p in found]) for _, found in groups]
