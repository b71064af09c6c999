"""Readers and writers for landed files.

Every reader takes an explicit schema; nothing is inferred. Writers use the
Hive ``key=value`` layout with dynamic partition overwrite so a re-run replaces
only the partitions it produced.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import DEFAULT_NULL_TOKENS, file_month, month_start, normalize_nulls
from . import clustering, probe


def land_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    null_tokens: Sequence[str] = DEFAULT_NULL_TOKENS,
    header: bool = True,
    partitions: int | None = None,
    about: dict[str, Column] | None = None,
) -> DataFrame:
    """Read (optionally gzip) CSV with a schema and normalise null tokens.

    With a header the columns are found by name (see ``read_csv``). Gzip files
    cannot be split, so each file is one task; ``partitions`` redistributes
    rows afterwards for the downstream stages. ``about`` adds columns computed
    from ``_metadata``, such as the source file's name (headered files).
    """
    df = read_csv(spark, path, schema, about) if header else read_csv_headerless(spark, path, schema)
    string_cols = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    df = df.select(*[normalize_nulls(c, null_tokens).alias(c) if c in string_cols else F.col(c) for c in df.columns])
    return df.repartition(partitions) if partitions else df


def with_file_month(df: DataFrame, name: str = "dt", pattern: str | None = None) -> DataFrame:
    """Month parsed from the source file name via the ``_metadata`` column."""
    src = F.col("_metadata.file_name")
    return df.withColumn(name, file_month(src) if pattern is None else file_month(src, pattern))


def only_new_partitions(df: DataFrame, landed: DataFrame, key: str = "dt") -> DataFrame:
    """Rows whose partition value is not landed yet (S3), by anti-join."""
    done = landed.select(F.col(key).alias("__landed")).distinct()
    return df.join(done, F.col(key) == F.col("__landed"), "left_anti")


def write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str], compression: str = "snappy", mode: str = "overwrite"
) -> None:
    """Parquet in Hive layout (S4); with dynamic overwrite only touched partitions are replaced."""
    (
        df.write.mode(mode)
        .option("compression", compression)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Re-run replaces its own partitions and leaves the others."""
    write_partitioned(df, path, keys, mode="overwrite")


def load_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet read with an explicit schema and path glob."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def read_harmonised(
    spark: SparkSession,
    groups: str | Sequence[str] | Sequence[Sequence[str]],
    double_cols: Sequence[str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read files whose numeric types drifted and unify them as DOUBLE.

    The files are grouped by the types in their footers, which one job reads on
    the executors (a given grouping is only a list of them); each group is read with its own types, cast, and the
    groups are unioned by name.
    """
    paths = [groups] if isinstance(groups, str) else [p for g in groups for p in ([g] if isinstance(g, str) else g)]
    frames = []
    for own, found in probe.type_groups(spark, paths):
        df = spark.read.schema(own).parquet(*found)
        df = df.select(*[F.col(c).cast("double").alias(c) if c in double_cols else F.col(c) for c in df.columns])
        frames.append(df)
    if not frames:
        raise FileNotFoundError(str(paths))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if schema is not None:
        out = out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return out


def explode_parallel_arrays(
    df: DataFrame, struct_col: str, keep: Sequence[str] = (), time_field: str = "time", date_name: str = "obs_date"
) -> DataFrame:
    """A struct of equally long arrays becomes one row per index.

    ``inline(arrays_zip(...))`` runs per row inside the task; no grouping.
    """
    fields = [f.name for f in df.schema[struct_col].dataType.fields]
    zipped = F.arrays_zip(*[F.col(f"{struct_col}.{f}").alias(f) for f in fields])
    out = df.select(*keep, F.inline(zipped))
    if time_field in fields:
        out = out.withColumn(date_name, F.to_date(F.col(time_field).cast("timestamp")))
    return out


def read_csv_headerless(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Headerless CSV with supplied column names and types."""
    return spark.read.schema(schema).option("header", False).option("mode", "FAILFAST").csv(path)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    about: dict[str, Column] | None = None,
    also: dict[str, str] | None = None,
) -> DataFrame:
    """Headered CSV with columns found by name, whatever their order.

    All fields are read as text under the file's own header, then the columns
    of ``schema`` are selected and cast; extra columns are ignored, a missing
    one is an error, and so is a value that its type cannot hold. ``also`` names
    a second header name of a column. Epoch columns
    (LONG, named ``firstseen`` or ``lastseen``) may hold timestamp text instead
    of a number. Files whose headers differ are read one header at a time; the
    headers are looked up in one job (see ``probe``). ``about`` adds columns
    computed from ``_metadata``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    headers = probe.header_groups(spark, paths)
    frames = [_by_name(spark, group, names, schema, about or {}, also or {}) for names, group in headers]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _by_name(
    spark: SparkSession,
    paths: Sequence[str],
    names: Sequence[str],
    schema: T.StructType,
    about: dict[str, Column],
    also: dict[str, str],
) -> DataFrame:
    found = {f.name: f.name if f.name in names else also.get(f.name) for f in schema.fields}
    missing = [n for n, source in found.items() if source not in names]
    if missing:
        raise ValueError(f"columns {missing} are not in the header of {list(paths)[:3]}: {list(names)}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.schema(text).option("header", True).option("mode", "FAILFAST").csv(list(paths))
    return df.select(*[_typed(found[f.name], f) for f in schema.fields], *[c.alias(n) for n, c in about.items()])


EPOCH_COLUMNS = ("firstseen", "lastseen")


def _typed(name: str, f: T.StructField) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(f.dataType, T.LongType) and f.name in EPOCH_COLUMNS:
        text = F.unix_millis(c.cast("timestamp"))
        return F.when(c.rlike(r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}"), text).otherwise(c.cast("long")).alias(f.name)
    return c.cast(f.dataType).alias(f.name)


SEED_SCHEMA = T.StructType(
    [
        T.StructField("station", T.StringType(), False),
        T.StructField("iata", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
    ]
)


def read_seed(spark: SparkSession, path: str, schema: T.StructType = SEED_SCHEMA) -> DataFrame:
    """Seed CSV (S12); its key column may be headed ``airport_icao`` instead of ``station``."""
    return read_csv(spark, path, schema, also={"station": "airport_icao"})


def write_small_csv(df: DataFrame, path: str, max_rows: int = 10_000) -> None:
    """A small ranked result as one headered CSV file.

    Only for bounded results: one writer task receives every row, so the row
    count is checked first.
    """
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"write_small_csv: more than {max_rows} rows")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def materialise(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """View or written table (X1). A table cuts the lineage."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if path is None:
        raise ValueError("a table needs a path")
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


def write_layout(
    df: DataFrame,
    path: str,
    month_of: str | None,
    cluster: Sequence[str] = (),
    month_name: str = "month",
    mode: str = "overwrite",
    max_records_per_file: int = 5_000_000,
    interleave: bool = False,
    row_group_bytes: int | None = None,
) -> int:
    """Partition by month of a date column and cluster by up to four keys.

    Rows are rebalanced by (month, cluster keys) and sorted inside each task:
    adaptive execution splits what is larger than its advisory size, a heavy
    (month, keys) combination included, and merges what is smaller, so no
    sampling pass runs the input twice and no key fills one task. Each Parquet
    row group carries tight min/max statistics on the cluster keys. Without
    cluster keys a hash of the row spreads a month. Returns the number of rows
    written, counted during the write.

    Statistics of rows sorted by one key after the other prune on the first key.
    With ``interleave`` the rows are ordered by a Z-order key over the cluster
    keys (see ``clustering``) and dealt to tasks by ranges of it, so a filter on
    any of the keys alone skips most row groups; that costs a sample and a
    sampling pass over the input. ``row_group_bytes`` sets the writer's row
    group size.
    """
    if len(cluster) > 4:
        raise ValueError("at most four cluster keys")
    out = df
    writer_keys: list[str] = []
    order: list = [F.col(c) for c in cluster]
    if month_of is not None:
        out = out.withColumn(month_name, month_start(month_of))
        writer_keys = [month_name]
        order = [F.col(month_name)] + (order or [F.xxhash64(*[F.col(c) for c in df.columns])])
    if interleave and cluster:
        out = clustering.with_key(out, cluster, "__z")
        order = [F.col(c) for c in writer_keys] + [F.col("__z")]
        out = out.repartitionByRange(*order).sortWithinPartitions(*order).drop("__z")
    elif order:
        out = out.hint("rebalance", *order).sortWithinPartitions(*order)
    obs = Observation(f"layout_{uuid.uuid4().hex[:8]}")
    w = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records_per_file)
    if row_group_bytes is not None:
        w = w.option("parquet.block.size", row_group_bytes)
    if writer_keys:
        w = w.partitionBy(*writer_keys)
    w.parquet(path)
    return int(obs.get["rows"])


def write_clustered(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Write with rows sorted on ``by`` inside every file (X2, cluster part).

    Each file's row groups then cover narrow ranges of the first key, so
    Parquet min/max statistics let range filters on it skip row groups. The
    existing partitioning is kept: no shuffle, no sampling pass over the
    input (a range repartition would recompute everything upstream once more
    to sample it), and no key-based routing that a hot key could overload.
    """
    df.sortWithinPartitions(*[F.col(c) for c in by]).write.mode(mode).parquet(path)


def load_summary(df: DataFrame, path: str, name: str = "load_summary") -> int:
    """Write ``df`` as Parquet and report the rows written without a second scan."""
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])
