from .aggregates import avg_of_counts, collapse_duplicates, group_count, profile_stats
from .joins import (
    anti_join,
    baseline_join,
    equi_join,
    full_outer_counts,
    hot_buckets,
    interval_join,
    range_lookup,
    restrict_to_top,
    semi_join,
    time_bucket_join,
    touches_any,
    with_membership_flag,
)
from .sets import movements, union_all
from .topn import top_n, total_order
from .windows import dedup_latest, first_per_key, mode_per_key

__all__ = [
    "anti_join",
    "avg_of_counts",
    "baseline_join",
    "collapse_duplicates",
    "dedup_latest",
    "equi_join",
    "first_per_key",
    "full_outer_counts",
    "group_count",
    "mode_per_key",
    "movements",
    "profile_stats",
    "hot_buckets",
    "interval_join",
    "range_lookup",
    "restrict_to_top",
    "semi_join",
    "time_bucket_join",
    "top_n",
    "total_order",
    "touches_any",
    "union_all",
    "with_membership_flag",
]
