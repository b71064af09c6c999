"""Bit-interleaved (Z-order) sort keys, so that files are narrow in several columns at once.

Sorting by one column after the other leaves min/max statistics that prune on
the first column only. Here every column is replaced by its rank among the
column's own boundaries, and the bits of the ranks are interleaved: rows that
are close in the key are close in all columns.

Boundaries come from a sample of at most ``SAMPLE_ROWS`` rows, drawn by a hash
in one pass with a bounded top-k in each task. They shape the layout only: any
boundaries give the same rows, and no result depends on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_ROWS = 1 << 14
BITS = 6
TEXT_CHARS = 64


def _comparable(df: DataFrame, name: str) -> Column:
    """A short value that orders like the column; dates and times by their place on the line, texts by their beginning."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        return F.substring(c, 1, TEXT_CHARS)
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    return c


def boundaries(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Up to ``2 ** bits - 1`` increasing values per column that cut its distinct sampled rows into equal parts."""
    draw = F.xxhash64(F.monotonically_increasing_id())
    sample = df.select(*[_comparable(df, c).alias(c) for c in columns], draw.alias("__draw")).orderBy("__draw").limit(SAMPLE_ROWS).drop("__draw").collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None and r[c] == r[c])
        picked = (values[len(values) * k // (1 << bits)] for k in range(1, 1 << bits)) if values else ()
        out[c] = sorted(set(picked))
    return out


def _rank(value: Column, cuts: list, low: int = 0) -> Column:
    """How many of the cuts are at most the value, by bisection: one comparison for each halving."""
    if not cuts:
        return F.lit(low)
    middle = len(cuts) // 2
    return F.when(value < F.lit(cuts[middle]), _rank(value, cuts[:middle], low)).otherwise(_rank(value, cuts[middle + 1 :], low + middle + 1))


def with_key(df: DataFrame, columns: Sequence[str], name: str, bits: int = BITS) -> DataFrame:
    """``df`` with its Z-order key over up to four columns: a whole number of ``bits`` bits a column.

    Nulls rank with the lowest values.
    """
    if not 1 <= len(columns) <= 4:
        raise ValueError("one to four cluster keys")
    cuts = boundaries(df, columns, bits)
    names = [f"__rank_{i}" for i in range(len(columns))]
    ranked = df.withColumns({n: F.when(F.col(c).isNull(), 0).otherwise(_rank(_comparable(df, c), cuts[c])) for n, c in zip(names, columns, strict=True)})
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i, n in enumerate(names):
            place = bit * len(columns) + len(columns) - 1 - i
            key = key.bitwiseOR(F.shiftleft(F.shiftright(n, bit).bitwiseAND(F.lit(1)).cast("long"), place))
    return ranked.withColumn(name, key).drop(*names)
