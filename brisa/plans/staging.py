"""Cleaning models (C1-C5): raw landed tables to typed, de-duplicated frames.

Standard movement columns produced by ``stg_movements`` and read by every
later model: movement_id, callsign, carrier, flight_number, asset_id,
asset_registration, asset_type, origin, destination, movement_date,
first_seen_at, last_seen_at, duration_minutes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    BACKSLASH_N,
    any_not_null,
    flag_equals,
    hour_bucket,
    minutes_between,
    nanos_to_timestamp,
    null_sentinel,
    prefix,
    safe_timestamp_millis,
    surrogate_key,
)
from ..operators.windows import dedup_latest

MOVEMENT_COLUMNS = [
    "movement_id",
    "callsign",
    "carrier",
    "flight_number",
    "asset_id",
    "asset_registration",
    "asset_type",
    "origin",
    "destination",
    "movement_date",
    "first_seen_at",
    "last_seen_at",
    "duration_minutes",
]

POSITION_COLUMNS = ["latitude_1", "longitude_1", "altitude_1", "latitude_2", "longitude_2", "altitude_2"]


def stg_movements(raw: DataFrame, carrier_chars: int = 3, keep_positions: bool = True) -> DataFrame:
    """Raw movement log to one clean row per movement.

    Raw columns: callsign, number, icao24, registration, typecode, origin,
    destination, day (``YYYY-MM-DD`` optionally followed by a time), firstseen
    and lastseen (epoch milliseconds), optional positions.

    Filters (P3-P6): a day, at least one endpoint, both epochs present, end not
    before start, both epochs convertible. Then one row per (callsign, date,
    first seen), the latest last-seen first, remaining columns as tie-break
    (W1, trap T4). The id hashes the parsed date, so both spellings of ``day``
    give the same id.

    The id, the carrier and the duration follow from the key and the last-seen
    time, so they decide no tie and are computed for the rows that stay: the
    shuffle and its sort carry the raw columns only.
    """
    day = F.to_date(F.substring(F.col("day"), 1, 10), "yyyy-MM-dd")
    first = safe_timestamp_millis("firstseen")
    last = safe_timestamp_millis("lastseen")
    positions = [c for c in POSITION_COLUMNS if keep_positions and c in raw.columns]
    cleaned = raw.filter(
        F.col("day").isNotNull()
        & any_not_null(["origin", "destination"])
        & F.col("firstseen").isNotNull()
        & F.col("lastseen").isNotNull()
        & (F.col("lastseen") >= F.col("firstseen"))
        & first.isNotNull()
        & last.isNotNull()
    ).select(
        "callsign", "number", "icao24", "registration", "typecode", "origin", "destination", day.alias("movement_date"), "firstseen", "lastseen", *positions
    )
    kept = dedup_latest(
        cleaned,
        ["callsign", "movement_date", "firstseen"],
        [F.col("lastseen").desc_nulls_last()],
        tie_break=[c for c in cleaned.columns if c not in ("callsign", "movement_date", "firstseen", "lastseen")],
    )
    return kept.select(
        surrogate_key("callsign", "movement_date", "firstseen").alias("movement_id"),
        F.col("callsign"),
        prefix("callsign", carrier_chars).alias("carrier"),
        F.col("number").alias("flight_number"),
        F.col("icao24").alias("asset_id"),
        F.col("registration").alias("asset_registration"),
        F.col("typecode").alias("asset_type"),
        F.col("origin"),
        F.col("destination"),
        F.col("movement_date"),
        first.alias("first_seen_at"),
        last.alias("last_seen_at"),
        minutes_between("firstseen", "lastseen").alias("duration_minutes"),
        *positions,
    )


def stg_observations(
    raw: DataFrame,
    measures: Sequence[str],
    station: str = "airport_icao",
    nanos: str = "obs_time",
    obs_date: str | None = "obs_date",
) -> DataFrame:
    """Raw hourly observations to typed rows with an hour bucket.

    Output: observation_id, station, observed_at, observation_date,
    observation_hour, measures.
    """
    observed = nanos_to_timestamp(nanos)
    date_col = F.col(obs_date) if obs_date else F.to_date(observed)
    return raw.select(
        surrogate_key(station, F.col(nanos).cast("string")).alias("observation_id"),
        F.col(station).alias("station"),
        observed.alias("observed_at"),
        date_col.alias("observation_date"),
        hour_bucket(observed).alias("observation_hour"),
        *[F.col(m).cast("double").alias(m) for m in measures],
    )


def stg_places(raw: DataFrame) -> DataFrame:
    """Reference place list, renamed and typed, rows without id dropped.

    Raw columns: ident, iata_code, name, type, latitude_deg, longitude_deg,
    elevation_ft, iso_country, iso_region, municipality, scheduled_service,
    gps_code.
    """
    return raw.filter(F.col("ident").isNotNull()).select(
        F.col("ident").alias("station"),
        F.col("iata_code").alias("station_iata"),
        F.col("name").alias("place_name"),
        F.col("type").alias("place_type"),
        F.col("latitude_deg").cast("double").alias("latitude"),
        F.col("longitude_deg").cast("double").alias("longitude"),
        F.col("elevation_ft").cast("double").alias("elevation_ft"),
        F.col("iso_country").alias("country"),
        F.col("iso_region").alias("region"),
        F.col("municipality"),
        F.col("scheduled_service"),
        F.col("gps_code"),
    )


def stg_carriers(raw: DataFrame, sentinel: str = BACKSLASH_N) -> DataFrame:
    """Carrier reference list with sentinel nulls; rows without code dropped (C4).

    Raw columns: airline_id, name, alias, iata, icao, callsign, country,
    active. ``is_active`` stays null when the flag is null (T18).
    """
    icao = null_sentinel("icao", sentinel)
    return raw.filter(icao.isNotNull()).select(
        F.col("airline_id").cast("long").alias("carrier_id"),
        null_sentinel("name", "").alias("carrier_name"),
        null_sentinel("alias", sentinel).alias("carrier_alias"),
        null_sentinel("iata", sentinel).alias("carrier_iata"),
        icao.alias("carrier"),
        null_sentinel("callsign", sentinel).alias("radio_callsign"),
        null_sentinel("country", sentinel).alias("country"),
        flag_equals("active", "Y").alias("is_active"),
    )


def stg_routes(raw: DataFrame, sentinel: str = BACKSLASH_N) -> DataFrame:
    """Route list with sentinel nulls, rows without both endpoints dropped.

    ``is_codeshare`` is false when the flag is null (T18).
    """
    src = null_sentinel("source_airport", sentinel)
    dst = null_sentinel("destination_airport", sentinel)
    return raw.filter(src.isNotNull() & dst.isNotNull()).select(
        null_sentinel("airline", sentinel).alias("carrier_code"),
        null_sentinel("airline_id", sentinel).alias("carrier_id"),
        src.alias("origin"),
        null_sentinel("source_airport_id", sentinel).alias("origin_id"),
        dst.alias("destination"),
        null_sentinel("destination_airport_id", sentinel).alias("destination_id"),
        flag_equals("codeshare", "Y", null_as=False).alias("is_codeshare"),
        F.col("stops").cast("long").alias("stops"),
        null_sentinel("equipment", sentinel).alias("equipment"),
    )
