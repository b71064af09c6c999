"""Rebuilding only what changed (S5, X1): from changed input files to the month partitions that depend on them.

A build leaves a record under ``_build/<number>`` in its output folder: the
state of every input file, and which months the rows of each input part
(a month folder, or a file outside such folders) fall into. The next build
compares the input's listing with the record and derives, table by table, the
months to replace:

- staged movements: months that a changed part has now or had at the last
  build; they are staged anew from all parts that hold rows of them, so that
  duplicates over several files are settled as in a full build;
- movements with conditions: those, and months with a movement that begins or
  ends in a month of a changed observation part;
- monthly profiles, sketches and bitmaps: the same months;
- recovery and carrier performance: also the same calendar month of every year,
  where a month of the base year changed.

Months are removed and written again (dynamic overwrite); other partitions are
not touched. Tables that no month partitions (baseline, dimensions, route risk)
are written anew from the staged tables. A changed reference file or hub list,
or no record, means a full build. The record is written last, so a build that
was cut off is done again; what a build reads is never what it replaces.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import WEATHER_RULES, Rule
from ..functions.scalars import month_start, nanos_to_timestamp
from ..sources import files, ledger, probe, schemas
from . import dims, marts, staging, warehouse

FILES = "input string, part string, path string, source string"
MONTHS = "input string, part string, month date"
LOGS = ("flights", "weather")
BY_MONTH = (
    "stg_movements",
    "movements_with_conditions",
    "hub_recovery",
    "hub_resilience",
    "resilience_sketches",
    "hub_day_bitmaps",
    "carrier_performance",
)


@dataclass
class Report:
    """What a build did: ``kind`` is full, partial or none; ``months`` lists the replaced months of each partitioned table."""

    kind: str
    months: dict[str, list[dt.date]] = field(default_factory=dict)


def _part(path: Column) -> Column:
    folder = F.regexp_extract(path, r"/(?:dt|month|obs_month|layout_month)=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(path)


def input_files(spark: SparkSession, inp: warehouse.Inputs) -> DataFrame:
    """One row per input file in its present state, by listing alone."""
    frames = []
    for name in ("flights", "weather", "airports", "airlines", "routes", "hub_seed"):
        path = getattr(inp, name)
        if path is not None:
            found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter("length > 0")
            found = found.filter(~F.col("path").rlike(r"/[_.][^/]*(/|$)"))
            frames.append(found.select(F.lit(name).alias("input"), _part(F.col("_metadata.file_path")).alias("part"), "path", ledger.source_identity().alias("source")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _record(spark: SparkSession, out_dir: str) -> str | None:
    """Folder of the last finished build's record."""
    folder = ledger._Folder(spark, out_dir)
    done = [n for n in folder.names("_build") if "done" in folder.names("_build", n)]
    return f"{out_dir}/_build/{done[-1]}" if done else None


def _months_of(spark: SparkSession, name: str, found: DataFrame) -> DataFrame:
    """``MONTHS`` rows of the listed files of a log: the months that their rows fall into."""
    paths = [probe.plain(r["path"]) for r in found.filter(F.col("input") == name).select("path").collect()]
    if not paths:
        return spark.createDataFrame([], MONTHS)
    if name == "flights":
        day, schema = F.to_date(F.substring(F.col("day"), 1, 10), "yyyy-MM-dd"), schemas.FLIGHTS_RAW
    else:
        day, schema = F.to_date(nanos_to_timestamp("obs_time")), schemas.WEATHER_RAW
    rows = files.load_parquet(spark, paths, schema).select(F.lit(name).alias("input"), _part(F.col("_metadata.file_path")).alias("part"), month_start(day).alias("month"))
    return rows.filter(F.col("month").isNotNull()).distinct()


def _in(column: str, months: Iterable[dt.date]) -> Column:
    months = sorted(months)
    return F.col(column).isin(months) if months else F.lit(False)


def _dates(df: DataFrame, column: str = "month") -> set[dt.date]:
    """Distinct months: as many rows as there are months."""
    return {r[0] for r in df.select(column).distinct().collect() if r[0] is not None}


def _write_record(spark: SparkSession, out_dir: str, found: DataFrame, months: DataFrame) -> None:
    folder = ledger._Folder(spark, out_dir)
    number = f"{int((folder.names('_build') or ['-1'])[-1]) + 1:08d}"
    found.write.parquet(f"{out_dir}/_build/{number}/files")
    months.write.parquet(f"{out_dir}/_build/{number}/months")
    spark.range(1).coalesce(1).write.parquet(f"{out_dir}/_build/{number}/done")


def build(
    spark: SparkSession,
    inp: warehouse.Inputs,
    out_dir: str,
    calendar: marts.Calendar = marts.Calendar(),
    rules: list[Rule] = WEATHER_RULES,
) -> Report:
    """Bring the tables of ``warehouse.run`` in ``out_dir`` up to date with the inputs (Parquet logs)."""
    out_dir = out_dir.rstrip("/")
    # The listing is taken once: files that arrive during the build belong to the next one.
    rows = input_files(spark, inp).collect()
    found = spark.createDataFrame(rows, FILES)
    record = _record(spark, out_dir)
    if record is not None:
        before = spark.read.schema(FILES).parquet(f"{record}/files")
        same = found.join(before, ["input", "part", "path", "source"], "left_semi")
        changed = found.exceptAll(same).unionByName(before.join(found, ["input", "part", "path", "source"], "left_anti"))
        changed = {(r["input"], r["part"]) for r in changed.select("input", "part").distinct().collect()}
        if not changed:
            return Report("none")
    if record is None or any(i not in LOGS for i, _ in changed) or not _same_hubs(spark, inp, out_dir, calendar):
        # A full build writes the months that there are now; months of an earlier build must not stay beside them.
        for name in BY_MONTH:
            ledger._Folder(spark, out_dir).remove(name)
        warehouse.run(spark, inp, out_dir, calendar, rules)
        hubs = warehouse.read_inputs(spark, inp, calendar)["hubs"]
        hubs.write.mode("overwrite").parquet(f"{out_dir}/hubs")
        _write_record(spark, out_dir, found, _months_of(spark, "flights", found).unionByName(_months_of(spark, "weather", found)))
        return Report("full")

    touched = spark.createDataFrame(sorted(changed), "input string, part string")
    months_before = spark.read.schema(MONTHS).parquet(f"{record}/months")
    old = months_before.join(touched, ["input", "part"], "left_semi")
    fresh = found.join(touched, ["input", "part"], "left_semi")
    new = _months_of(spark, "flights", fresh).unionByName(_months_of(spark, "weather", fresh))
    both = old.unionByName(new)
    # Parts that hold rows of a month, as of now.
    holding = months_before.join(touched, ["input", "part"], "left_anti").unionByName(new)
    holding = spark.createDataFrame(holding.collect(), MONTHS)

    def paths_of(name: str, months: set[dt.date]) -> list[str]:
        parts = holding.filter((F.col("input") == name) & _in("month", months)).select("input", "part").distinct()
        return [probe.plain(r["path"]) for r in found.join(parts, ["input", "part"], "left_semi").select("path").collect()]

    report = Report("partial")

    def read(name: str, months: Iterable[dt.date] | None = None) -> DataFrame:
        back = spark.read.parquet(f"{out_dir}/{name}")
        return (back if months is None else back.filter(_in("layout_month", months))).drop("layout_month")

    def replace(name: str, df: DataFrame, months: set[dt.date], month_of: str, cluster: tuple) -> None:
        folder = ledger._Folder(spark, f"{out_dir}/{name}")
        for m in sorted(months):
            folder.remove(f"layout_month={m}")
        if months:
            files.write_layout(df, f"{out_dir}/{name}", month_of, cluster, month_name="layout_month")
        report.months[name] = sorted(months)

    # Staged movements.
    moved = _dates(both.filter(F.col("input") == "flights"))
    if moved:
        paths = paths_of("flights", moved)
        raw = warehouse.read_flights(spark, paths) if paths else spark.createDataFrame([], schemas.FLIGHTS_RAW)
        replace("stg_movements", staging.stg_movements(raw).filter(_in_month("movement_date", moved)), moved, "movement_date", ("origin", "destination"))
    stg = read("stg_movements")

    # Movements with conditions.
    seen = _dates(both.filter(F.col("input") == "weather"))
    at_ends = [month_start(F.to_date(c)) for c in ("first_seen_at", "last_seen_at")]
    met = _dates(stg.filter(at_ends[0].isin(sorted(seen)) | at_ends[1].isin(sorted(seen))).select(month_start("movement_date").alias("month"))) if seen else set()
    affected = moved | met
    facts = read("stg_movements", affected)
    hours = _dates(facts.select(F.explode(F.array(*at_ends)).alias("month")))
    paths = paths_of("weather", hours)
    weather = files.load_parquet(spark, paths, schemas.WEATHER_RAW) if paths else spark.createDataFrame([], schemas.WEATHER_RAW)
    hubs = spark.read.parquet(f"{out_dir}/hubs").select("station", "iata", F.col("name").alias("place_name"), "country")
    observations = staging.stg_observations(weather, schemas.WEATHER_MEASURE_FIELDS)
    cond = marts.movements_with_conditions(facts, observations, hubs, marts.WEATHER_MEASURES, rules, split_hot=True)
    replace("movements_with_conditions", cond, affected, "movement_date", ("origin", "destination"))

    # Tables without month partitions, from the staged ones.
    whole = {"dim_asset": lambda: dims.dim_asset(stg), "traffic_baseline": lambda: marts.traffic_baseline(stg, hubs, calendar.base_year)} if moved else {}
    whole["route_risk"] = lambda: marts.route_risk(read("movements_with_conditions"), calendar)
    for name, make in whole.items():
        files.write_layout(make(), f"{out_dir}/{name}", None, ("origin", "destination") if name == "route_risk" else ())

    # Marts by month.
    cond = read("movements_with_conditions", affected)
    replace("hub_resilience", marts.resilience_profile(cond, hubs), affected, "month", ("hub", "event"))
    replace("resilience_sketches", marts.resilience_sketches(cond, hubs), affected, "month", ("hub", "event"))
    replace("hub_day_bitmaps", marts.hub_day_bitmaps(cond, hubs), affected, "month", ("hub", "event"))
    base = {m.month for m in affected if m.year == calendar.base_year}
    there = {dt.date.fromisoformat(n.split("=")[1]) for n in ledger._Folder(spark, f"{out_dir}/movements_with_conditions").names() if n.startswith("layout_month=")}
    wider = affected | {m for m in there if m.month in base}
    phases = dims.dim_phase(spark, calendar.base_year)
    recovery = marts.recovery(read("movements_with_conditions", wider), hubs, spark.read.parquet(f"{out_dir}/traffic_baseline"), phases)
    replace("hub_recovery", recovery, wider, "month", ("hub",))
    needed = wider | {m for m in there if m.year == calendar.base_year and m.month in {w.month for w in wider}}
    carriers = marts.carrier_performance(read("movements_with_conditions", needed), hubs, calendar.base_year).filter(_in("month", wider))
    replace("carrier_performance", carriers, wider, "month", ("carrier",))
    _write_record(spark, out_dir, found, holding)
    return report


def _in_month(column: str, months: Iterable[dt.date]) -> Column:
    return month_start(column).isin(sorted(months))


def _same_hubs(spark: SparkSession, inp: warehouse.Inputs, out_dir: str, calendar: marts.Calendar) -> bool:
    """Whether the hub list is still the one of the tables; a ranked one follows the movements."""
    if inp.hub_seed:
        return True
    now = warehouse.build_hub_seed(spark, inp.flights, inp.airports, year=calendar.base_year)
    return set(map(tuple, now.collect())) == set(map(tuple, spark.read.parquet(f"{out_dir}/hubs").collect()))
