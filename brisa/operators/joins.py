"""Join operators.

No side is hinted for broadcast: the planner's size estimates and AQE's
measured bytes choose the strategy (a top-N result or a literal lookup is
estimated small and broadcast; a set of any other length is not assumed to
be). Where both sides are shuffled AQE splits hot key partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import hour_bucket

# Tasks over which facts without a join key are spread in a shuffle.
NULL_KEY_SALTS = 256
# Keys that a sketch follows as candidates for hot ones, and how much smaller than a task's fair share the pieces of a hot key are.
HOT_KEYS = 1024
HOT_PIECES = 64


def with_membership_flag(df: DataFrame, key: str, set_df: DataFrame, set_key: str, name: str) -> DataFrame:
    """Add ``name`` = key is in ``set_df`` (P13); null keys give false.

    The set is de-duplicated. It always carries the same column name, so
    repeated flags against one set share one exchange (the planner reuses the
    identical one) and the set is computed once.
    """
    keys = set_df.select(F.col(set_key).alias("__in_set")).distinct()
    joined = df.join(keys, df[key] == F.col("__in_set"), "left")
    return joined.withColumn(name, F.col("__in_set").isNotNull()).drop("__in_set")


def touches_any(df: DataFrame, cols: Sequence[str], set_df: DataFrame, set_key: str) -> DataFrame:
    """Keep rows where any of ``cols`` is in ``set_df`` (J9, disjunctive semi-join)."""
    flags = []
    out = df
    for i, c in enumerate(cols):
        name = f"__touch_{i}"
        out = with_membership_flag(out, c, set_df, set_key, name)
        flags.append(F.col(name))
    cond = flags[0]
    for f in flags[1:]:
        cond = cond | f
    return out.filter(cond).drop(*[f"__touch_{i}" for i in range(len(cols))])


def semi_join(df: DataFrame, key: str, set_df: DataFrame, set_key: str) -> DataFrame:
    """``key in (select set_key from set_df)``.

    A semi-join never multiplies rows, so the set is not de-duplicated.
    """
    keys = set_df.select(F.col(set_key).alias("__semi_key"))
    return df.join(keys, df[key] == F.col("__semi_key"), "left_semi")


def anti_join(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """``not exists (select 1 from other where other_key = key)``."""
    keys = other.select(F.col(other_key).alias("__anti_key"))
    return df.join(keys, df[key] == F.col("__anti_key"), "left_anti")


def _bucket(ts: str, unit: str) -> Column:
    return hour_bucket(ts) if unit == "hour" else F.date_trunc(unit, F.col(ts))


def hot_buckets(facts: DataFrame, station: str, ts: str, unit: str = "hour", tasks: int | None = None) -> DataFrame:
    """The (station, time bucket) pairs that hold many of the facts (J5): ``item, pieces``.

    ``item`` is a hash of the pair. One aggregate over two columns: a
    frequent-items sketch with a fixed number of counters, merged over the
    tasks, so at most ``HOT_KEYS`` rows come out whatever the input's size. A
    pair is hot above ``1 / HOT_PIECES`` of a task's fair share of the rows, and
    is to be cut into pieces of that size. Estimates decide about the cutting
    only, never about what joins.
    """
    tasks = tasks or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = facts.filter(F.col(station).isNotNull() & F.col(ts).isNotNull()).select(F.xxhash64(F.col(station), _bucket(ts, unit)).alias("item"))
    found = keyed.agg(F.expr(f"approx_top_k(item, {HOT_KEYS}, {8 * HOT_KEYS})").alias("top"), F.count(F.lit(1)).alias("rows"))
    pieces = F.ceil(F.col("hot.count") * F.lit(tasks * HOT_PIECES) / F.col("rows")).cast("int")
    return found.select("rows", F.explode("top").alias("hot")).select(F.col("hot.item").alias("item"), pieces.alias("pieces")).filter("pieces > 1")


def time_bucket_join(
    facts: DataFrame,
    obs: DataFrame,
    fact_station: str,
    fact_ts: str,
    measures: Sequence[str],
    prefix: str,
    obs_station: str = "station",
    obs_bucket: str = "observation_hour",
    unit: str = "hour",
    matched_name: str | None = None,
    broadcast: bool | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left-join facts to the observation of their station and time bucket.

    ``obs`` must be unique on ``(obs_station, obs_bucket)`` (see
    ``collapse_duplicates``) so the join is 1:1 and never multiplies facts.
    Measures arrive as ``{prefix}{measure}``; ``matched_name`` (default
    ``{prefix}matched``) records whether an observation was found. Facts
    without a station or time match nothing; in a shuffle a salt spreads them
    over tasks, as they would otherwise all share one key. ``broadcast`` is for
    callers that know the observations' size; by default the planner decides.

    ``hot`` (see ``hot_buckets``) names pairs that hold many facts: their facts
    are dealt over the pair's pieces, and their one observation is repeated for
    each piece, so that no pair is one task's work in a shuffle.
    """
    matched_name = matched_name or f"{prefix}matched"
    st, bk, salt = f"__{prefix}station", f"__{prefix}bucket", f"__{prefix}salt"
    right = obs.select(
        F.col(obs_station).alias(st),
        F.col(obs_bucket).alias(bk),
        F.lit(0).alias(salt),
        *[F.col(m).alias(f"{prefix}{m}") for m in measures],
    )
    keyless = F.col(fact_station).isNull() | F.col(fact_ts).isNull()
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(NULL_KEY_SALTS)).cast("int")
    left = facts.withColumns({bk + "_l": _bucket(fact_ts, unit), salt + "_l": F.when(keyless, spread).otherwise(F.lit(0))})
    if hot is not None:
        # At most HOT_KEYS rows.
        small = F.broadcast(hot.select(F.col("item").alias("__item"), F.col("pieces").alias("__pieces")))
        dealt = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns], F.monotonically_increasing_id()), F.col("__pieces")).cast("int")
        left = left.join(small, F.xxhash64(F.col(fact_station), F.col(bk + "_l")) == F.col("__item"), "left")
        left = left.withColumn(salt + "_l", F.when(F.col("__pieces").isNotNull(), dealt).otherwise(F.col(salt + "_l"))).drop("__item", "__pieces")
        cut = right.drop(salt).join(small, F.xxhash64(F.col(st), F.col(bk)) == F.col("__item"), "left")
        right = cut.withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1))).drop("__item", "__pieces")
    if broadcast:
        right = F.broadcast(right)
    joined = left.join(
        right,
        (left[fact_station] == right[st]) & (left[bk + "_l"] == right[bk]) & (left[salt + "_l"] == right[salt]),
        "left",
    )
    return joined.withColumn(matched_name, F.col(st).isNotNull()).drop(st, bk, salt, bk + "_l", salt + "_l")


def _position(value: Column, kind: T.DataType) -> Column:
    """A whole number that orders like the value."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(value.cast("timestamp"), "UTC"))
    if isinstance(kind, T.IntegralType):
        return value.cast("long")
    raise TypeError(f"no range join on {kind.simpleString()}: dates, timestamps and whole numbers only")


def interval_join(
    points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, on: Sequence[tuple[str, str]] = (), how: str = "inner"
) -> DataFrame:
    """Rows of ``points`` with every range that holds them, ``start <= point <= end`` (J6), by equality joins only.

    A range of length n is filed under the smallest power of two above n: at
    that width it touches one bucket or two. A point looks into one bucket of
    every width that occurs (at most 63). So a range is held twice at most
    however long it is, long and short ranges can be mixed, and only rows of one
    bucket are compared. ``on`` adds pairs of equal columns.

    Points are looked up once per distinct value (and ``on`` columns), combined
    inside each task before the shuffle, so a value that very many rows share is
    one row in the lookup; the rows then meet their ranges by equality on the
    value, where AQE splits a hot one. With ``how="left"`` points without a
    range stay, with nulls. Null points, null ends and ranges that end before
    they start match nothing; overlapping ranges all match.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    if points.schema[point].dataType != ranges.schema[start].dataType or ranges.schema[start].dataType != ranges.schema[end].dataType:
        raise TypeError(f"{point}, {start} and {end} differ in type: cast them first")
    at = _position(F.col(point), points.schema[point].dataType)
    low, high = (_position(F.col(c), ranges.schema[c].dataType) for c in (start, end))
    keys = [f"__on_{i}" for i in range(len(on))]
    spans = ranges.select(
        F.struct(*[F.col(c) for c in ranges.columns]).alias("__range"), low.alias("__low"), high.alias("__high"), *[F.col(r).alias(k) for k, (_, r) in zip(keys, on, strict=True)]
    ).filter("__low <= __high")
    # Binary digits of the length: the width 2 ** digits is above it.
    spans = spans.withColumn("__level", F.when(F.col("__high") == F.col("__low"), F.lit(0)).otherwise(F.length(F.bin(F.col("__high") - F.col("__low")))))
    first, last = F.expr("shiftright(__low, __level)"), F.expr("shiftright(__high, __level)")
    filed = spans.withColumn("__bucket", F.explode(F.when(first == last, F.array(first)).otherwise(F.array(first, last))))
    # One row: the widths that occur.
    levels = spans.agg(F.collect_set("__level").alias("__levels"))
    values = points.filter(F.col(point).isNotNull()).select(at.alias("__at"), *[F.col(c).alias(k) for k, (c, _) in zip(keys, on, strict=True)]).distinct()
    looking = values.join(F.broadcast(levels), F.lit(True)).withColumn("__level", F.explode("__levels")).drop("__levels")
    looking = looking.withColumn("__bucket", F.expr("shiftright(__at, __level)"))
    if not keys:
        # Few bytes, but each row may meet very many ranges: a fixed number of tasks, which adaptive execution does not merge.
        looking = looking.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__level", "__at")
    hits = looking.join(filed, [*keys, "__level", "__bucket"]).filter("__at between __low and __high").select("__at", "__range", *keys)
    hits = hits.withColumnsRenamed({k: f"{k}_r" for k in keys} | {"__at": "__at_r"})
    left = points.withColumns({"__at": at} | {k: F.col(c) for k, (c, _) in zip(keys, on, strict=True)})
    cond = left["__at"] == hits["__at_r"]
    for k in keys:
        cond = cond & (left[k] == hits[f"{k}_r"])
    out = left.join(hits, cond, how)
    return out.select(*[left[c] for c in points.columns], *[F.col(f"__range.`{c}`").alias(c) for c in ranges.columns])


def range_lookup(
    df: DataFrame, date_col: str, ranges: DataFrame, start: str, end: str, how: str = "left", literal: bool = False
) -> DataFrame:
    """Join each row to the ranges with ``start <= date <= end``.

    No row is compared with every range (see ``interval_join``), unless the
    caller says that ``ranges`` is a ``literal`` list of a few: then one pass
    over the rows does.
    """
    if literal:
        return df.join(F.broadcast(ranges), df[date_col].between(ranges[start], ranges[end]), how)
    return interval_join(df, ranges, date_col, start, end, how=how)


def full_outer_counts(
    a: DataFrame, b: DataFrame, keys: Sequence[str], a_count: str, b_count: str, total: str | None = None
) -> DataFrame:
    """Full outer join of two counts, keys coalesced, missing counts as 0."""
    la = a.select(*[F.col(k).alias(f"__a_{k}") for k in keys], F.col(a_count).alias("__a_n"))
    lb = b.select(*[F.col(k).alias(f"__b_{k}") for k in keys], F.col(b_count).alias("__b_n"))
    cond = None
    for k in keys:
        c = la[f"__a_{k}"] == lb[f"__b_{k}"]
        cond = c if cond is None else cond & c
    j = la.join(lb, cond, "full")
    cols = [F.coalesce(F.col(f"__a_{k}"), F.col(f"__b_{k}")).alias(k) for k in keys]
    an = F.coalesce(F.col("__a_n"), F.lit(0)).cast("long")
    bn = F.coalesce(F.col("__b_n"), F.lit(0)).cast("long")
    cols += [an.alias(a_count), bn.alias(b_count)]
    if total:
        cols.append((an + bn).alias(total))
    return j.select(*cols)


def baseline_join(
    df: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    month_col: str,
    base_month_col: str,
    base_cols: Sequence[str],
) -> DataFrame:
    """Left join on ``keys`` plus the calendar month of ``month_col``.

    ``base`` carries the calendar month (1-12) in ``base_month_col``. The
    calendar month is computed on the left first so the join stays an
    equi-join.
    """
    right = base.select(
        *[F.col(k).alias(f"__b_{k}") for k in keys],
        F.col(base_month_col).alias("__b_cm"),
        *[F.col(c) for c in base_cols],
    )
    left = df.withColumn("__cm", F.month(F.col(month_col)))
    cond = left["__cm"] == right["__b_cm"]
    for k in keys:
        cond = cond & (left[k] == right[f"__b_{k}"])
    out = left.join(right, cond, "left")
    return out.drop("__cm", "__b_cm", *[f"__b_{k}" for k in keys])


def restrict_to_top(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """Keep rows whose ``key`` is among the top ``n`` by ``sum(measure)``.

    Ties on the total are broken by the key so the set is deterministic.
    """
    top = (
        df.groupBy(key)
        .agg(F.sum(measure).alias("__lifetime"))
        .orderBy(F.col("__lifetime").desc(), F.col(key).asc())
        .limit(n)
        .select(F.col(key).alias("__top_key"))
    )
    return df.join(top, df[key] == F.col("__top_key"), "inner").drop("__top_key")


def equi_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]] | Column, how: str = "inner") -> DataFrame:
    """Equi-join on pairs of (left column, right column)."""
    if isinstance(on, Column):
        return left.join(right, on, how)
    cond = None
    for lc, rc in on:
        c = left[lc] == right[rc]
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)
