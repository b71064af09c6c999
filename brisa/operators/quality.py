"""Data-quality checks as Spark jobs (Q1-Q13).

Every check yields rows of the shape ``CHECK_SCHEMA``. ``failures`` follows
the usual generic-test convention: number of offending rows for not-null,
range and singular checks; number of offending *values* for unique and
accepted-values checks; 0 or 1 for whole-table checks (row count, mean).
Column-wise checks of one relation are folded into a single aggregate pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ["check_name", "relation", "column_name", "severity", "failures", "status"]


def _status(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).when(severity == "warn", F.lit("warn")).otherwise(F.lit("error"))


def finished(df: DataFrame) -> DataFrame:
    """Add the status column and fix types and order."""
    return df.select(
        F.col("check_name").cast("string"),
        F.col("relation").cast("string"),
        F.col("column_name").cast("string"),
        F.col("severity").cast("string"),
        F.col("failures").cast("long"),
        _status(F.col("failures").cast("long"), F.col("severity")).alias("status"),
    )


@dataclass
class RangeRule:
    column: str
    min_value: float | None = None
    max_value: float | None = None
    row_condition: Column | None = None
    severity: str = "error"


@dataclass
class RelationChecks:
    """Column-level checks of one relation, evaluated in one aggregate pass."""

    relation: str
    not_null: Sequence[str] = ()
    accepted: dict[str, Sequence[str]] = field(default_factory=dict)
    ranges: Sequence[RangeRule] = ()
    mean_between: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    row_count_between: tuple[int | None, int | None] | None = None
    singular: dict[str, Column] = field(default_factory=dict)
    severity: str = "error"


def _outside(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return cond


def relation_checks(df: DataFrame, spec: RelationChecks) -> DataFrame:
    """not_null (Q1), accepted_values (Q3), range (Q8), mean (Q9), row count (Q7)
    and row-condition singular checks (Q10, Q12) in one aggregate pass.

    Each accepted-values check is a branch of its own over the rows that fail
    it: several distinct counts in one aggregate would multiply every row.
    """
    aggs: list[Column] = []
    meta: list[tuple[str, str, str]] = []

    def add(check: str, column: str, agg: Column, severity: str) -> None:
        aggs.append(agg.cast("long").alias(f"c{len(aggs)}"))
        meta.append((check, column, severity))

    for c in spec.not_null:
        add("not_null", c, F.count_if(F.col(c).isNull()), spec.severity)
    apart = [
        _single(
            df.filter(~F.col(c).isin(list(values))).select(c).distinct().agg(F.count(F.lit(1)).alias("failures")),
            "accepted_values",
            spec.relation,
            c,
            spec.severity,
        )
        for c, values in spec.accepted.items()
    ]
    for r in spec.ranges:
        bad = _outside(F.col(r.column), r.min_value, r.max_value)
        if r.row_condition is not None:
            bad = r.row_condition & bad
        add("range", r.column, F.count_if(bad), r.severity)
    for c, (lo, hi) in spec.mean_between.items():
        add("mean_range", c, F.when(_outside(F.avg(F.col(c)), lo, hi), 1).otherwise(0), spec.severity)
    if spec.row_count_between is not None:
        lo, hi = spec.row_count_between
        add("row_count", "*", F.when(_outside(F.count(F.lit(1)), lo, hi), 1).otherwise(0), spec.severity)
    for check, cond in spec.singular.items():
        add(check, "*", F.count_if(cond), spec.severity)
    if not aggs and not apart:
        raise ValueError("no checks given")
    if not aggs:
        return union_checks(apart)
    one = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(spec.relation).alias("relation"),
                F.lit(column).alias("column_name"),
                F.lit(sev).alias("severity"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, (check, column, sev) in enumerate(meta)
        ]
    )
    out = finished(one.select(F.inline(rows)))
    if not apart:
        return out
    # A few rows, in the order of the specification: the accepted values after the null checks.
    place = F.when(F.col("check_name") == "not_null", 0).when(F.col("check_name") == "accepted_values", 1).otherwise(2)
    return union_checks([out, *apart]).coalesce(1).sortWithinPartitions(place)


def _single(df_count: DataFrame, check: str, relation: str, column: str, severity: str) -> DataFrame:
    return finished(
        df_count.select(
            F.lit(check).alias("check_name"),
            F.lit(relation).alias("relation"),
            F.lit(column).alias("column_name"),
            F.lit(severity).alias("severity"),
            F.col("failures"),
        )
    )


def unique(df: DataFrame, relation: str, cols: Sequence[str], severity: str = "error") -> DataFrame:
    """Key values occurring more than once (Q2; Q6 for several columns).

    A single-column key ignores nulls; a composite key groups nulls together.
    """
    src = df.filter(F.col(cols[0]).isNotNull()) if len(cols) == 1 else df
    dup = src.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    name = "unique" if len(cols) == 1 else "unique_combination"
    return _single(dup.agg(F.count(F.lit(1)).alias("failures")), name, relation, ",".join(cols), severity)


def relationships(
    child: DataFrame, relation: str, col: str, parent: DataFrame, parent_col: str, severity: str = "error"
) -> DataFrame:
    """Child rows whose non-null key has no parent (Q4, Q5).

    The child is counted per key first, so only distinct keys are shuffled.
    """
    keys = parent.select(F.col(parent_col).alias("__pk")).distinct()
    counted = child.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("__ck")).agg(F.count(F.lit(1)).alias("__n"))
    orphans = counted.join(keys, F.col("__ck") == F.col("__pk"), "left_anti")
    failures = F.coalesce(F.sum("__n"), F.lit(0)).alias("failures")
    return _single(orphans.agg(failures), "relationships", relation, col, severity)


def rows_matching(df: DataFrame, check: str, relation: str, condition: Column, severity: str = "error") -> DataFrame:
    """Singular test: rows satisfying ``condition`` are failures (Q10, Q12)."""
    return _single(df.agg(F.count_if(condition).alias("failures")), check, relation, "*", severity)


def keys_missing(
    keys: DataFrame, key: str, target: DataFrame, target_key: str, check: str, relation: str, severity: str = "error"
) -> DataFrame:
    """Singular test: keys with no row in ``target`` (Q11, anti-join)."""
    missing = keys.join(target.select(F.col(target_key).alias("__tk")), F.col(key) == F.col("__tk"), "left_anti")
    return _single(missing.agg(F.count(F.lit(1)).alias("failures")), check, relation, key, severity)


def landing_before_takeoff(df: DataFrame, relation: str, first: str, last: str) -> DataFrame:
    """Q10: an end timestamp before its start."""
    return rows_matching(df, "no_end_before_start", relation, F.col(last) < F.col(first))


def bucket_within_day(
    df: DataFrame, relation: str, date_col: str, ends: Sequence[tuple[str, str]], tolerance_days: int = 1
) -> DataFrame:
    """Q12: a matched observation must lie within ``tolerance_days`` of the fact's date.

    ``ends`` lists (event column, timestamp column) pairs.
    """
    return rows_matching(df, "observation_within_day", relation, outside_day(date_col, ends, tolerance_days))


def outside_day(date_col: str, ends: Sequence[tuple[str, str]], tolerance_days: int = 1) -> Column:
    """Row condition of Q12: an end with an event lies more than ``tolerance_days`` from the date."""
    cond = F.lit(False)
    for event_col, ts_col in ends:
        far = F.abs(F.datediff(F.to_date(F.col(ts_col)), F.col(date_col))) > tolerance_days
        cond = cond | (F.col(event_col).isNotNull() & far)
    return cond


def summary(checks: Sequence[DataFrame]) -> DataFrame:
    """Q13: number of checks per status."""
    allc = union_checks(checks)
    return allc.groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))


def union_checks(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack check rows of several checks, pair by pair: a chain would be analysed anew at every link."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [frames[i].unionAll(frames[i + 1]) for i in range(0, len(frames) - 1, 2)]
        frames = pairs + frames[len(pairs) * 2 :]
    return frames[0]
