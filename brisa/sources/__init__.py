from .files import (
    SEED_SCHEMA,
    explode_parallel_arrays,
    land_csv,
    load_parquet,
    load_summary,
    materialise,
    only_new_partitions,
    overwrite_partitions,
    read_csv,
    read_csv_headerless,
    read_harmonised,
    read_seed,
    with_file_month,
    write_layout,
    write_partitioned,
    write_small_csv,
)
from .lookups import EVENTS, PHASES_2019, date_spine, date_spine_between, events, lookup, phase_rows, phases
from .merging import merge_latest

__all__ = [
    "EVENTS",
    "PHASES_2019",
    "SEED_SCHEMA",
    "date_spine",
    "date_spine_between",
    "events",
    "explode_parallel_arrays",
    "land_csv",
    "load_parquet",
    "load_summary",
    "lookup",
    "materialise",
    "merge_latest",
    "only_new_partitions",
    "overwrite_partitions",
    "phase_rows",
    "phases",
    "read_csv",
    "read_csv_headerless",
    "read_harmonised",
    "read_seed",
    "with_file_month",
    "write_layout",
    "write_partitioned",
    "write_small_csv",
]
