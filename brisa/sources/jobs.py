"""Ingest jobs assembled from the readers and writers.

Each job is one distributed Spark job over already-landed files; downloads
and uploads are outside its scope.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import file_month
from . import files, ledger, probe, schemas


log = logging.getLogger(__name__)


def name_month(path: Column) -> Column:
    """Month in a file's own name."""
    return file_month(F.element_at(F.split(path, "/"), -1))


def land_files(
    spark: SparkSession,
    source: str | Sequence[str],
    out_dir: str,
    schema: T.StructType,
    resume: bool = True,
    partitions: int | None = None,
    unmatched: str = "fail",
    month_of: Callable[[Column], Column] = name_month,
) -> int:
    """Monthly CSV files -> Parquet partitioned by ``dt``, through the file ledger.

    With ``resume`` the files whose present state the ledger does not hold are
    landed, a later file of a landed month included, and a replaced file takes
    the place of its earlier state; without, the months in the input are
    replaced by it. A run that was killed is finished or cleared first. ``dt``
    is what ``month_of`` sees in a path; a file without a month is an error that
    names it, unless ``unmatched="skip"``: then it is left out and reported with
    its row count. Gzip files are not splittable, so rows are redistributed
    before the write when ``partitions`` is given. Returns the rows written.
    """
    if unmatched not in ("fail", "skip"):
        raise ValueError("unmatched is 'fail' or 'skip'")
    try:
        found = ledger.listing(spark, source, month_of)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(source) from e
        raise
    strange = sorted(r["path"] for r in found.filter(F.col("dt").isNull()).select("path").collect())
    if strange:
        if unmatched == "fail":
            raise ValueError(f"{len(strange)} files without a month in their name: {strange[:20]}")
        rows = files.land_csv(spark, [probe.plain(p) for p in strange], schema).count()
        log.warning("skipped %d files (%d rows) without a month in their name: %s", len(strange), rows, strange[:20])
    ledger.recover(spark, out_dir)
    found = found.filter(F.col("dt").isNotNull())
    known = ledger.entries(spark, out_dir)
    todo = ledger.pending(found, known) if resume else found
    # One row per new file: the reader needs their paths, and the ledger must not list anew after the data were read.
    rows = todo.collect()
    if not rows:
        return 0
    if resume and (unknown := ledger.unknown_months(spark, out_dir, sorted({str(r["dt"]) for r in rows}), known)):
        raise ValueError(f"months {unknown} were landed without a ledger: enter their files with ledger.adopt, or land them with resume=False")
    todo = spark.createDataFrame(rows, todo.schema)
    load = ledger.new_load(spark, out_dir)
    about = {"dt": month_of(F.col("_metadata.file_path")), "source": ledger.source_identity()}
    full = [probe.plain(r["path"]) for r in rows if r["length"]]
    columns = T.StructType([*schema.fields, T.StructField("dt", T.DateType()), T.StructField("source", T.StringType())])
    data = files.land_csv(spark, full, schema, partitions=partitions, about=about) if full else spark.createDataFrame([], columns)
    ledger.stage(data, out_dir, load)
    written = ledger.commit(todo, out_dir, load, whole=not resume)
    ledger.publish(spark, out_dir, load)
    return written


def land_flight_files(
    spark: SparkSession,
    source_glob: str,
    out_dir: str,
    resume: bool = True,
    partitions: int | None = None,
    unmatched: str = "fail",
) -> int:
    """Monthly gzip CSV movement files -> Parquet by the month in the file name (see ``land_files``)."""
    return land_files(spark, source_glob, out_dir, schemas.FLIGHTS_RAW, resume, partitions, unmatched)


def load_observation_files(spark: SparkSession, paths: Sequence[str], out_dir: str) -> int:
    """An explicit list of observation files (station x year) -> one table in the month layout.

    Partitioned by the month of ``obs_date`` and clustered by station. Files
    whose measures were written with drifting numeric types go through
    ``harmonise_observation_files`` first.
    """
    df = files.load_parquet(spark, list(paths), schemas.WEATHER_RAW)
    return files.write_layout(df, out_dir, "obs_date", ["airport_icao"], month_name="obs_month")


def harmonise_observation_files(spark: SparkSession, groups: Sequence[Sequence[str]], out_dir: str) -> DataFrame:
    """Rewrite observation files with all measures as DOUBLE."""
    df = files.read_harmonised(spark, groups, schemas.WEATHER_MEASURE_FIELDS, schema=schemas.WEATHER_RAW)
    df.write.mode("overwrite").parquet(out_dir)
    return spark.read.parquet(out_dir)


def land_reference_files(spark: SparkSession, airports_csv: str, airlines_dat: str, routes_dat: str, out_dir: str) -> dict[str, int]:
    """Reference CSVs (headered places, headerless carriers and routes) -> Parquet."""
    frames = {
        "airports": files.read_csv(spark, airports_csv, schemas.AIRPORTS_RAW),
        "airlines": files.read_csv_headerless(spark, airlines_dat, schemas.AIRLINES_RAW),
        "routes": files.read_csv_headerless(spark, routes_dat, schemas.ROUTES_RAW),
    }
    return {name: files.load_summary(df, os.path.join(out_dir, name), name=f"ref_{name}") for name, df in frames.items()}
