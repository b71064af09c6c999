"""Scalar column helpers.

All helpers build JVM-side expressions from ``pyspark.sql.functions`` so they
stay inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Null tokens recognised when landing flat files.
DEFAULT_NULL_TOKENS = ("", "nan", "NaN", "null", "None")
# Fixed value: the sentinel a reference-data export uses for a missing field.
BACKSLASH_N = "\\N"
# Fixed value: placeholder hashed in place of a null key part.
SURROGATE_NULL = "__null__"
# Range of epoch milliseconds that maps to years 0001-9999.
MIN_EPOCH_MILLIS = -62135596800000
MAX_EPOCH_MILLIS = 253402300799999


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_sentinel(c: ColumnOrName, *tokens: str) -> Column:
    """``nullif(trim(c), token)`` for each token (F1 + F2)."""
    out = F.trim(_col(c))
    for t in tokens or (BACKSLASH_N,):
        out = F.nullif(out, F.lit(t))
    return out


def normalize_nulls(c: ColumnOrName, tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> Column:
    """Multi-token null normalisation at load time.

    The CSV reader accepts a single ``nullValue``; every other token is mapped
    here. Strings are compared after trimming.
    """
    col = _col(c)
    return F.when(F.trim(col).isin(list(tokens)), F.lit(None).cast("string")).otherwise(col)


def surrogate_key(*cols: ColumnOrName) -> Column:
    """Deterministic hash of several columns, null-safe."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def safe_timestamp_millis(c: ColumnOrName) -> Column:
    """Epoch milliseconds to timestamp, null when outside years 1-9999."""
    col = _col(c)
    return F.when(col.between(MIN_EPOCH_MILLIS, MAX_EPOCH_MILLIS), F.timestamp_millis(col))


def epoch_millis(ts: ColumnOrName) -> Column:
    """Timestamp to epoch milliseconds (inverse of F9)."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def nanos_to_timestamp(c: ColumnOrName) -> Column:
    """Epoch nanoseconds to timestamp via exact integer division to micros.

    The division runs on DECIMAL: a DOUBLE cannot hold epoch nanoseconds
    exactly (53-bit mantissa) and would shift some values by a microsecond.
    """
    return F.timestamp_micros(F.floor(_col(c).cast("decimal(20,0)") / F.lit(1000)).cast("long"))


def hour_bucket(ts: ColumnOrName) -> Column:
    """Truncate a timestamp to its hour (F11). Result type is ``timestamp``."""
    return F.date_trunc("hour", _col(ts))


def month_start(d: ColumnOrName) -> Column:
    """First day of the month as DATE."""
    return F.trunc(_col(d).cast("date"), "month")


def quarter_start(d: ColumnOrName) -> Column:
    """First day of the quarter as DATE."""
    return F.trunc(_col(d).cast("date"), "quarter")


def sunday_week(d: ColumnOrName) -> Column:
    """Week number with Sunday as first day; days before the first Sunday are week 0."""
    col = _col(d)
    return F.floor((F.dayofyear(col) - F.dayofweek(col) + F.lit(7)) / F.lit(7)).cast("int")


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields null on a zero or null denominator."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def minutes_between(first_ms: ColumnOrName, last_ms: ColumnOrName, digits: int = 2) -> Column:
    """Elapsed minutes between two epoch-millisecond values, rounded.

    The divisor is a double literal so the result is DOUBLE, not DECIMAL.
    """
    return F.round((_col(last_ms) - _col(first_ms)) / F.lit(60000.0), digits)


def prefix(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters, 1-based like SQL ``substr``."""
    return F.substring(_col(c), 1, n)


def flag_equals(c: ColumnOrName, value: str, null_as: bool | None = None) -> Column:
    """Boolean from a trimmed equality test.

    ``null_as=None`` keeps three-valued logic (null stays null); a boolean
    replaces the null outcome.
    """
    out = F.trim(_col(c)) == F.lit(value)
    return out if null_as is None else F.coalesce(out, F.lit(null_as))


def in_year(c: ColumnOrName, year: int) -> Column:
    """Year equality written as a half-open range so both bounds reach the scan."""
    col = _col(c)
    return (col >= F.lit(f"{year:04d}-01-01").cast("date")) & (col < F.lit(f"{year + 1:04d}-01-01").cast("date"))


def between_dates(c: ColumnOrName, start: str, end: str) -> Column:
    """Inclusive date range."""
    return _col(c).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def any_not_null(cols: Iterable[ColumnOrName]) -> Column:
    """At least one of the columns is not null."""
    out = None
    for c in cols:
        cond = _col(c).isNotNull()
        out = cond if out is None else (out | cond)
    return out


def file_month(path_col: ColumnOrName, pattern: str = r"flightlist_(\d{4})(\d{2})\d{2}_\d{8}") -> Column:
    """Month start date parsed from a file name."""
    col = _col(path_col)
    y = F.regexp_extract(col, pattern, 1)
    m = F.regexp_extract(col, pattern, 2)
    return F.when(y != "", F.to_date(F.concat_ws("-", y, m, F.lit("01")), "yyyy-MM-dd"))
