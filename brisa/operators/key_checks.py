"""Uniqueness and foreign keys of many relations in one shuffle (Q2, Q4, Q6, Q11).

Every relation is read once, whatever the number of its checks; a row gives one
narrow entry per check: the check's number and two independent 64-bit hashes of
the key. Entries are counted inside each task, and one exchange brings equal
hashes of the same check together, so no key itself is shuffled. Two keys that
agree in all 128 bits count as equal; for n keys the chance that any two
different ones do is below ``n * n / 2 ** 129``.

Whole-number keys that are dense (ids counted up from a start) need not be
shuffled at all: ``dense=True`` builds bitmaps of 32,768 numbers with an
aggregate. A stretch with as many set bits as rows has no repeated key; a
stretch where the child's bits add none to the parent's has no orphan. Only rows
of the other stretches are checked key by key, exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import quality


@dataclass
class UniqueKey:
    """No key occurs twice. One column: nulls are left out; several: nulls are equal to each other."""

    relation: str
    df: DataFrame
    columns: Sequence[str]
    severity: str = "error"
    dense: bool = False


@dataclass
class ForeignKey:
    """Every key that is not null is in the parent's column; failures are the child's rows without a parent."""

    relation: str
    df: DataFrame
    column: str
    parent: DataFrame
    parent_column: str
    severity: str = "error"
    dense: bool = False
    check: str = "relationships"


def _hashes(df: DataFrame, columns: Sequence[str], as_text: bool = False) -> list[Column]:
    parts: list[Column] = []
    for c in columns:
        value = F.col(c)
        if isinstance(df.schema[c].dataType, T.FractionalType) and not isinstance(df.schema[c].dataType, T.DecimalType):
            value = value + F.lit(0.0)  # one zero
        value = value.cast("string") if as_text else value
        # The hash of a null is that of nothing: say where it is.
        parts += [value, value.isNull()]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def _entry(number: int, keep: Column, hashes: list[Column], child: int) -> list[Column]:
    """``check, h1, h2, child``; rows that are left out have no check."""
    return [F.when(keep, number).alias("check"), hashes[0].alias("h1"), hashes[1].alias("h2"), F.lit(child).alias("child")]


def _hashed(rules: Sequence[tuple[int, UniqueKey | ForeignKey]]) -> DataFrame:
    """One row with a column ``c<number>`` of failures for each rule."""
    entries: dict[int, tuple[DataFrame, list[list[Column]]]] = {}

    def add(df: DataFrame, entry: list[Column]) -> None:
        entries.setdefault(id(df), (df, []))[1].append(entry)

    for number, r in rules:
        if isinstance(r, UniqueKey):
            keep = F.col(r.columns[0]).isNotNull() if len(r.columns) == 1 else F.lit(True)
            add(r.df, _entry(number, keep, _hashes(r.df, r.columns), 1))
        else:
            as_text = r.df.schema[r.column].dataType != r.parent.schema[r.parent_column].dataType
            add(r.df, _entry(number, F.col(r.column).isNotNull(), _hashes(r.df, [r.column], as_text), 1))
            add(r.parent, _entry(number, F.col(r.parent_column).isNotNull(), _hashes(r.parent, [r.parent_column], as_text), 0))
    frames = [df.select(*found[0]) if len(found) == 1 else df.select(F.inline(F.array(*[F.struct(*e) for e in found]))) for df, found in entries.values()]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionAll(f)
    keys = rows.filter("check is not null").groupBy("check", "h1", "h2").agg(F.sum("child").alias("rows"), F.min("child").alias("only_child"))
    return keys.agg(
        *[
            (
                F.count_if((F.col("check") == n) & (F.col("rows") > 1))
                if isinstance(r, UniqueKey)
                else F.coalesce(F.sum(F.when((F.col("check") == n) & (F.col("only_child") == 1), F.col("rows"))), F.lit(0))
            ).alias(f"c{n}")
            for n, r in rules
        ]
    )


def _stretches(df: DataFrame, column: str) -> DataFrame:
    n = F.col(column).cast("long")
    return df.filter(F.col(column).isNotNull()).select(n.alias("key"), F.bitmap_bucket_number(n).alias("bucket"), F.bitmap_bit_position(n).alias("bit"))


def _dense(number: int, r: UniqueKey | ForeignKey) -> DataFrame:
    """One row with the failures of a rule on dense whole numbers."""
    columns = r.columns if isinstance(r, UniqueKey) else [r.column]
    if len(columns) != 1 or not isinstance(r.df.schema[columns[0]].dataType, T.IntegralType):
        raise TypeError(f"dense keys are one whole-number column: {columns}")
    mine = _stretches(r.df, columns[0])
    if isinstance(r, UniqueKey):
        counts = mine.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.bitmap_count(F.bitmap_construct_agg("bit")).alias("keys"))
        suspects = counts.filter("rows > keys").select("bucket")
        again = mine.join(suspects, "bucket", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
        return again.agg(F.count(F.lit(1)).alias(f"c{number}"))
    theirs = _stretches(r.parent, r.parent_column)
    bits = [d.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).withColumn("parent", F.lit(p)) for d, p in ((mine, False), (theirs, True))]
    both = bits[0].unionAll(bits[1]).groupBy("bucket")
    held = F.coalesce(F.max(F.when(F.col("parent"), F.bitmap_count("bits"))), F.lit(0))
    suspects = both.agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"), held.alias("held")).filter(F.col("all") > F.col("held")).select("bucket")
    orphans = mine.join(suspects, "bucket", "left_semi").join(theirs.select("key"), "key", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias(f"c{number}"))


def key_checks(rules: Sequence[UniqueKey | ForeignKey]) -> DataFrame:
    """Check rows (see ``quality``) of all rules."""
    numbered = list(enumerate(rules))
    hashed = [(n, r) for n, r in numbered if not r.dense]
    ones = [_dense(n, r) for n, r in numbered if r.dense]
    if hashed:
        ones.append(_hashed(hashed))
    # One row each.
    one = ones[0]
    for o in ones[1:]:
        one = one.join(F.broadcast(o), F.lit(True))

    def row(n: int, r: UniqueKey | ForeignKey) -> Column:
        if isinstance(r, UniqueKey):
            check, column = ("unique" if len(r.columns) == 1 else "unique_combination"), ",".join(r.columns)
        else:
            check, column = r.check, r.column
        values = {"check_name": F.lit(check), "relation": F.lit(r.relation), "column_name": F.lit(column), "severity": F.lit(r.severity)}
        return F.struct(*[v.alias(k) for k, v in values.items()], F.col(f"c{n}").cast("long").alias("failures"))

    return quality.finished(one.select(F.inline(F.array(*[row(n, r) for n, r in numbered]))))
