"""Set-shaped operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import semi_join


def movements(
    df: DataFrame,
    ends: Sequence[dict[str, str]],
    carry: Sequence[str] = (),
    hubs: DataFrame | None = None,
    hub_key: str = "station",
    station_name: str = "hub",
) -> DataFrame:
    """One row per fact end, in a single pass over the facts.

    ``ends`` maps output column -> input column for each end, and must name
    ``station_name`` in every mapping, e.g.
    ``[{"hub": "origin", "event": "origin_event"}, {"hub": "destination", ...}]``.
    This replaces ``select .. union all select ..`` over the same input, which
    would scan the facts twice. With ``hubs`` given, ends whose station is not
    in the (bounded) hub set are dropped by a broadcast semi-join.
    """
    out_cols = list(ends[0].keys())
    structs = [
        F.struct(*[F.col(src).alias(dst) for dst, src in end.items()], F.lit(i).alias("end_index"))
        for i, end in enumerate(ends)
    ]
    exploded = df.select(*[F.col(c) for c in carry], F.inline(F.array(*structs)))
    exploded = exploded.filter(F.col(station_name).isNotNull())
    if hubs is not None:
        exploded = semi_join(exploded, station_name, hubs, hub_key)
    return exploded.select(*carry, *out_cols, "end_index")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """``union all`` by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
