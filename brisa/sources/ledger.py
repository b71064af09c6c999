"""A ledger of landed source files (S1, S3): which file, in which state, gave how many rows of which month.

A landing has three steps, and the second one commits it:

1. ``stage`` writes the rows of the new files under ``_staging/<load>`` in the
   target folder, one folder per month and source file (readers skip names that
   begin with an underscore);
2. ``commit`` writes one ledger row per source file, with its path, length,
   time, month and the rows that were really staged, as one file under
   ``_ledger/<load>``;
3. ``publish`` moves the staged files into their month folders. A file's name
   begins with the identity of its source file and the load, so an older
   version of the same source file is found by name and removed.

Each step can be repeated. A run killed before the commit leaves only a staging
folder that nothing refers to: the next run lands those files again and clears
it. A run killed after the commit is finished by the next run, which publishes
what is still staged. Either way no row is lost or doubled. A file is new when
its path, length and time together are not in the ledger: a later file of a
landed month, and a file that was replaced, are read; a source file that was
removed keeps its rows.

Ledger and listing are tables and are compared by an anti-join. Moving and
removing are metadata operations on this load's files; two landings into one
folder at the same time are not supported.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "load string, source string, path string, length long, modified timestamp, dt date, rows long, whole boolean"
MOVERS = 16


def source_identity() -> Column:
    """Sixteen hex digits for a file in its present state; for frames that are read from files."""
    state = F.concat_ws(
        "|", F.col("_metadata.file_path"), F.col("_metadata.file_size").cast("string"), F.unix_micros("_metadata.file_modification_time").cast("string")
    )
    return F.substring(F.sha2(state, 256), 1, 16)


def listing(spark: SparkSession, paths: str | Sequence[str], month_of: Callable[[Column], Column]) -> DataFrame:
    """``source, path, length, modified, dt`` of the files under ``paths``, by listing alone; ``month_of`` gives the month of a path.

    Spark does not list files of no bytes.
    """
    found = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths))
    return found.select(
        source_identity().alias("source"), "path", "length", F.col("modificationTime").alias("modified"), month_of(F.col("_metadata.file_path")).alias("dt")
    )


def entries(spark: SparkSession, out_dir: str) -> DataFrame:
    """All ledger rows of ``out_dir``; none where there is no ledger."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{out_dir.rstrip('/')}/_ledger/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def landed(spark: SparkSession, out_dir: str) -> DataFrame:
    """The ledger row of the latest state of each source file: what the month folders hold."""
    latest = F.max_by(F.struct("load", "source", "length", "modified", "dt", "rows"), F.col("load"))
    return entries(spark, out_dir).groupBy("path").agg(latest.alias("e")).select("path", "e.*")


def pending(files: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files whose present state is not in the ledger."""
    return files.join(known.select("source").distinct(), "source", "left_anti")


def new_load(spark: SparkSession, out_dir: str) -> str:
    """A name that sorts after those of all loads before."""
    last = entries(spark, out_dir).agg(F.max("load")).first()[0]
    number = int(last.split("-")[0]) + 1 if last else 0
    return f"{number:08d}-{uuid.uuid4().hex[:8]}"


def stage(rows: DataFrame, out_dir: str, load: str, compression: str = "snappy") -> str:
    """Write rows with ``dt`` and ``source`` columns to the load's staging folder."""
    path = f"{out_dir.rstrip('/')}/_staging/{load}"
    rows.write.mode("overwrite").option("compression", compression).partitionBy("dt", "source").parquet(path)
    return path


def commit(files: DataFrame, out_dir: str, load: str, whole: bool = False) -> int:
    """Enter ``files`` as landed by ``load``, with the rows staged for each; returns their sum.

    With ``whole`` the load replaces its months, whatever they held.
    """
    spark = files.sparkSession
    staged = spark.read.schema("dt date, source string").option("basePath", f"{out_dir.rstrip('/')}/_staging/{load}")
    counts = staged.parquet(f"{out_dir.rstrip('/')}/_staging/{load}").groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    names = LEDGER.replace(",", "").split()[::2]
    rows = files.join(counts, "source", "left").withColumns(
        {"load": F.lit(load), "rows": F.coalesce("rows", F.lit(0)).cast("long"), "whole": F.lit(whole)}
    )
    path = f"{out_dir.rstrip('/')}/_ledger/{load}"
    # One row a source file; one file, so that it appears whole or not at all.
    rows.select(*names).coalesce(1).write.parquet(path)
    return int(spark.read.schema(LEDGER).parquet(path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])


class _Folder:
    """Listing, moving and removing through the file system that Spark itself uses for a path."""

    def __init__(self, spark: SparkSession, root: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.root = self._hadoop.Path(root)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        out = self.root
        for p in parts:
            out = self._hadoop.Path(out, p)
        return out

    def names(self, *parts: str) -> list[str]:
        at = self.path(*parts)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def move(self, source: tuple[str, ...], target: tuple[str, ...]) -> None:
        self.fs.mkdirs(self.path(*target).getParent())
        if not self.fs.rename(self.path(*source), self.path(*target)):
            raise OSError(f"cannot move {self.path(*source)} to {self.path(*target)}")

    def remove(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)


def publish(spark: SparkSession, out_dir: str, load: str) -> None:
    """Move a committed load's staged files to their months, after removing what they replace.

    Replaced are files of earlier states of the same source files, and with
    ``whole`` everything that the load's months held before.
    """
    folder = _Folder(spark, out_dir.rstrip("/"))
    known = entries(spark, out_dir)
    mine = known.filter(F.col("load") == load)
    before = known.filter(F.col("load") < load)
    # One row per source file of this load, and one per month that it touches.
    earlier = before.join(mine.select("path").distinct(), "path", "left_semi").select(F.col("dt").cast("string").alias("dt"), "source").distinct().collect()
    months = {r["dt"]: r["whole"] for r in mine.groupBy(F.col("dt").cast("string").alias("dt")).agg(F.max("whole").alias("whole")).collect()}
    gone: dict[str, set[str]] = {}
    for r in earlier:
        gone.setdefault(r["dt"], set()).add(r["source"])
    drop = []
    for dt in sorted(set(months) | set(gone)):
        for name in folder.names(f"dt={dt}"):
            source, _, rest = name.partition("-")
            if not rest.startswith(load) and (months.get(dt) or source in gone.get(dt, ())):
                drop.append((f"dt={dt}", name))
    staged = [
        (dt, source, name)
        for dt in folder.names("_staging", load)
        if dt.startswith("dt=")
        for source in folder.names("_staging", load, dt)
        for name in folder.names("_staging", load, dt, source)
        if name.startswith("part-")
    ]
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(lambda parts: folder.remove(*parts), drop))
        moves = [(("_staging", load, dt, source, name), (dt, f"{source.removeprefix('source=')}-{load}-{name}")) for dt, source, name in staged]
        list(pool.map(lambda m: folder.move(*m), moves))
    folder.remove("_staging", load)


def unknown_months(spark: SparkSession, out_dir: str, months: Sequence[str], known: DataFrame) -> list[str]:
    """Those of ``months`` whose folder holds files although the ledger has no row of them (landed without a ledger)."""
    ledgered = {r["dt"] for r in known.select(F.col("dt").cast("string").alias("dt")).distinct().collect()}
    folder = _Folder(spark, out_dir.rstrip("/"))
    return [m for m in months if m not in ledgered and any(n[0] not in "_." for n in folder.names(f"dt={m}"))]


def adopt(files: DataFrame, out_dir: str) -> int:
    """Enter ``files`` as landed before there was a ledger, without reading them (their rows are not known: 0)."""
    spark = files.sparkSession
    load = new_load(spark, out_dir)
    stage(spark.createDataFrame([], "dt date, source string, nothing int"), out_dir, load)
    commit(files, out_dir, load)
    publish(spark, out_dir, load)
    return files.count()


def recover(spark: SparkSession, out_dir: str) -> list[str]:
    """Finish committed loads that are still staged and clear staging folders that were never committed; returns the former."""
    staged = _Folder(spark, out_dir.rstrip("/")).names("_staging")
    if not staged:
        return []
    committed = {r["load"] for r in entries(spark, out_dir).filter(F.col("load").isin(staged)).select("load").distinct().collect()}
    for load in staged:
        if load in committed:
            publish(spark, out_dir, load)
        else:
            _Folder(spark, out_dir.rstrip("/")).remove("_staging", load)
    return sorted(committed)
