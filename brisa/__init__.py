"""brisa: operational-resilience analytics as plain Spark DataFrame operators.

Layout
------
functions/  column-level helpers (scalar and conditional aggregate expressions)
operators/  DataFrame -> DataFrame building blocks (joins, aggregates, windows,
            set operations, top-k, data-quality checks)
sources/    readers and writers (CSV/JSON/Parquet landing, layout, lookups)
plans/      assembled models: staging, dimensions, marts, serving queries, and
            the mapping of the TPC-H-style test tables onto the domain roles
streaming/  incremental landing of new files with Structured Streaming

``python -m brisa`` runs the ingest jobs and the full build from the command
line; ``__spark_entry__`` at the repository root registers the queries over
the test tables.
"""

__version__ = "0.1.0"
