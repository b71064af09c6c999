from .classify import DEFAULT_LABEL, WEATHER_RULES, classify, prefixed
from .conditional import cond_avg, cond_count_distinct, cond_sum, count_where, pearson, share, weighted_avg
from .scalars import (
    any_not_null,
    between_dates,
    epoch_millis,
    file_month,
    flag_equals,
    hour_bucket,
    in_year,
    minutes_between,
    month_start,
    nanos_to_timestamp,
    normalize_nulls,
    null_sentinel,
    prefix,
    quarter_start,
    safe_divide,
    safe_timestamp_millis,
    sunday_week,
    surrogate_key,
)

__all__ = [
    "DEFAULT_LABEL",
    "WEATHER_RULES",
    "any_not_null",
    "between_dates",
    "classify",
    "cond_avg",
    "cond_count_distinct",
    "cond_sum",
    "count_where",
    "epoch_millis",
    "file_month",
    "flag_equals",
    "hour_bucket",
    "in_year",
    "minutes_between",
    "month_start",
    "nanos_to_timestamp",
    "pearson",
    "normalize_nulls",
    "null_sentinel",
    "prefix",
    "prefixed",
    "quarter_start",
    "safe_divide",
    "safe_timestamp_millis",
    "share",
    "sunday_week",
    "surrogate_key",
    "weighted_avg",
]
