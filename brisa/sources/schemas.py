"""Explicit schemas of the raw domain inputs; nothing is inferred."""

from pyspark.sql import types as T

S, L, D, DT = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Movement log: epochs are milliseconds; ``day`` is YYYY-MM-DD, sometimes with a time.
FLIGHTS_RAW = _schema(
    ("callsign", S),
    ("number", S),
    ("icao24", S),
    ("registration", S),
    ("typecode", S),
    ("origin", S),
    ("destination", S),
    ("firstseen", L),
    ("lastseen", L),
    ("day", S),
    ("latitude_1", D),
    ("longitude_1", D),
    ("altitude_1", D),
    ("latitude_2", D),
    ("longitude_2", D),
    ("altitude_2", D),
)

WEATHER_MEASURE_FIELDS = [
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "wind_gusts_10m",
    "wind_direction_10m",
    "precipitation",
    "rain",
    "snowfall",
    "snow_depth",
    "cloud_cover",
    "surface_pressure",
]

# Hourly observations: ``obs_time`` is epoch nanoseconds.
WEATHER_RAW = _schema(
    ("airport_icao", S),
    ("obs_time", L),
    ("obs_date", DT),
    *[(m, D) for m in WEATHER_MEASURE_FIELDS],
    ("latitude", D),
    ("longitude", D),
)

# API payload: one object per station with parallel hourly arrays.
WEATHER_PAYLOAD = T.StructType(
    [
        T.StructField("airport_icao", S),
        T.StructField("latitude", D),
        T.StructField("longitude", D),
        T.StructField(
            "hourly",
            T.StructType(
                [T.StructField("time", T.ArrayType(S))] + [T.StructField(m, T.ArrayType(D)) for m in WEATHER_MEASURE_FIELDS]
            ),
        ),
    ]
)

AIRPORTS_RAW = _schema(
    ("ident", S),
    ("iata_code", S),
    ("name", S),
    ("type", S),
    ("latitude_deg", D),
    ("longitude_deg", D),
    ("elevation_ft", D),
    ("iso_country", S),
    ("iso_region", S),
    ("municipality", S),
    ("scheduled_service", S),
    ("gps_code", S),
)

AIRLINES_RAW = _schema(
    ("airline_id", L),
    ("name", S),
    ("alias", S),
    ("iata", S),
    ("icao", S),
    ("callsign", S),
    ("country", S),
    ("active", S),
)

ROUTES_RAW = _schema(
    ("airline", S),
    ("airline_id", S),
    ("source_airport", S),
    ("source_airport_id", S),
    ("destination_airport", S),
    ("destination_airport_id", S),
    ("codeshare", S),
    ("stops", L),
    ("equipment", S),
)

HUB_SEED = _schema(("station", S), ("iata", S), ("name", S), ("country", S), ("latitude", D), ("longitude", D))

# Accepted place types of the reference place list.
PLACE_TYPES = [
    "large_airport",
    "medium_airport",
    "small_airport",
    "heliport",
    "seaplane_base",
    "balloonport",
    "closed",
]
