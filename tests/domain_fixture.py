"""Miniature hand-made inputs in the raw domain shapes (movement log, hourly
observations, reference files, hub seed)."""

from __future__ import annotations

import calendar
import datetime as dt
import os

from brisa.sources import schemas

HUBS = ["EAAC", "EAAB", "LAAD"]


def ms(y, mo, d, h=0, mi=0) -> int:
    return calendar.timegm(dt.datetime(y, mo, d, h, mi).timetuple()) * 1000


def ns(y, mo, d, h=0, mi=0) -> int:
    return ms(y, mo, d, h, mi) * 1_000_000


def flight(cs, o, d, first, last, day=None, num="1", icao24="a1", reg="R1", typ="A320"):
    if day is None and first is not None:
        day = dt.datetime.fromtimestamp(first / 1000, dt.UTC).strftime("%Y-%m-%d")
    return (cs, num, icao24, reg, typ, o, d, first, last, day, None, None, None, None, None, None)


def flights() -> list[tuple]:
    rows = [
        flight("BAW1", "EAAC", "EAAB", ms(2019, 3, 10, 10, 15), ms(2019, 3, 10, 11, 45)),  # snow at origin
        flight("BAW1", "EAAC", "EAAB", ms(2019, 3, 10, 10, 15), ms(2019, 3, 10, 11, 45)),  # exact duplicate
        flight("BAW1", "EAAC", "EAAB", ms(2019, 3, 10, 10, 15), ms(2019, 3, 10, 11, 45), day="2019-03-10 00:00:00+00:00"),
        flight("DLH2", "EAAB", "LAAD", ms(2019, 3, 10, 8, 0), ms(2019, 3, 10, 9, 0), icao24="b2", reg="R2"),
        flight("DLH2", "EAAB", "LAAD", ms(2019, 3, 10, 8, 0), ms(2019, 3, 10, 9, 30), icao24="b2", reg="R2"),  # later last seen wins
        flight("XXX9", None, "", ms(2019, 3, 12, 8, 0), ms(2019, 3, 12, 9, 0)),  # no endpoint ('' is a null token)
        flight("AFR3", "LAAD", "EAAC", ms(2019, 3, 11, 10, 0), ms(2019, 3, 11, 9, 0)),  # lands before take-off
        flight("AFR8", "LAAD", "EAAC", 300_000_000_000_000, 300_000_000_100_000, day="2019-03-11"),  # epoch out of range
        flight(None, "EAAC", "KJFK", ms(2019, 4, 1, 10, 0), ms(2019, 4, 1, 18, 0)),  # null call sign
        flight("BAW4", "EAAC", "LAAD", ms(2019, 3, 10, 23, 30), ms(2019, 3, 11, 0, 45), day="2019-03-10"),  # over midnight
        flight("BAW5", "EAAC", "KJFK", ms(2019, 5, 1, 9, 0), ms(2019, 5, 1, 17, 0)),  # hub to other
        flight("UAL6", "KJFK", "LAAD", ms(2019, 5, 2, 9, 0), ms(2019, 5, 2, 16, 0)),  # other to hub
        flight("UAL7", "KJFK", "KBOS", ms(2019, 5, 3, 9, 0), ms(2019, 5, 3, 10, 0)),  # other to other
        flight("BAW9", "EAAC", "LAAD", ms(2019, 1, 5, 15, 0), ms(2019, 1, 5, 16, 10)),  # same day as a snow flight
    ]
    # Route A: EAAC -> LAAD, 12 days in January 2019 at 07:00, plus two in the collapse window.
    rows += [flight(f"BAW{10 + d}", "EAAC", "LAAD", ms(2019, 1, d, 7, 0), ms(2019, 1, d, 8, 10)) for d in range(1, 13)]
    rows += [flight(f"BAW{40 + d}", "EAAC", "LAAD", ms(2020, 2, d, 7, 0), ms(2020, 2, d, 8, 10)) for d in (3, 4)]
    # Route B: EAAB -> EAAC, 11 days in February 2019, nothing in the collapse window.
    rows += [flight(f"DLH{20 + d}", "EAAB", "EAAC", ms(2019, 2, d, 12, 0), ms(2019, 2, d, 13, 20)) for d in range(1, 12)]
    # 2022: three EAAC departures in March.
    rows += [flight(f"BAW{60 + d}", "EAAC", "EAAB", ms(2022, 3, 5, 9, d), ms(2022, 3, 5, 10, 30 + d)) for d in range(3)]
    return rows


def weather() -> list[tuple]:
    def obs(st, y, mo, d, h, mi=0, snow=0.0, speed=2.0, gust=4.0, pres=1013.0, hum=60.0, cloud=20.0):
        return (st, ns(y, mo, d, h, mi), dt.date(y, mo, d), 10.0, hum, speed, gust, 180.0, 0.0, 0.0, snow, 0.0, cloud, pres, 0.0, 0.0)

    rows = [
        obs("EAAC", 2019, 3, 10, 10, snow=0.5),
        obs("EAAC", 2019, 3, 10, 10, 30, snow=0.0),  # sub-hour duplicate: mean snowfall 0.25 -> snow
        obs("EAAB", 2019, 3, 10, 11, speed=10.0, gust=15.0, pres=990.0, hum=90.0, cloud=80.0),  # all on thresholds -> clear
        obs("EAAB", 2019, 3, 10, 8, gust=25.0, pres=980.0),  # storm
        obs("LAAD", 2019, 3, 11, 0, hum=95.0, cloud=90.0),  # fog
        obs("EAAC", 2022, 3, 5, 9, speed=12.0),  # windy
    ]
    rows += [obs("EAAC", 2019, 1, d, 7, snow=1.0 if d == 5 else 0.0) for d in range(1, 13)]
    return rows


AIRPORTS = [
    ["EAAC", "NMF", "North Meadow Field", "large_airport", "51.25", "-0.5", "83", "GB", "GB-ENG", "Northtown", "yes", "EAAC"],
    ["EAAB", "ERF", "East Ridge Field", "large_airport", "50.5", "8.25", "364", "DE", "DE-HE", "Eastridge", "yes", "EAAB"],
    ["LAAD", "SBF", "South Basin Field", "large_airport", "48.75", "2.25", "392", "FR", "FR-IDF", "Southbasin", "yes", "LAAD"],
    ["KJFK", "JFK", "John F Kennedy International Airport", "large_airport", "40.64", "-73.78", "13", "US", "US-NY", "New York", "yes", "KJFK"],
    ["KBOS", "BOS", "Logan International Airport", "large_airport", "42.36", "-71.01", "20", "US", "US-MA", "Boston", "yes", "KBOS"],
]

AIRLINES = [
    '1,"British Airways",\\N,"BA","BAW","SPEEDBIRD","United Kingdom","Y"',
    '7,"British Airways Duplicate",\\N,\\N,"BAW",\\N,"United Kingdom","N"',
    '2,"Lufthansa",\\N,"LH","DLH","LUFTHANSA","Germany","Y"',
    '3,"Unknown Code",\\N,"ZZ",\\N,\\N,"Nowhere","Y"',
    '4,"  Padded  ",\\N,"PD"," UAL ",\\N,"United States",',
]

ROUTES = [
    'BA,1,NMF,507,ERF,340,,0,320',
    'LH,2,ERF,340,SBF,1382,Y,0,321',
    'BA,1,\\N,\\N,SBF,1382,,0,320',
    'UA,5,JFK,3797,\\N,\\N,Y,0,777',
]

SEED = [
    "airport_icao,iata,name,country,latitude,longitude",
    "EAAC,NMF,North Meadow Field,GB,51.25,-0.5",
    "EAAB,ERF,East Ridge Field,DE,50.5,8.25",
    "LAAD,SBF,South Basin Field,FR,48.75,2.25",
]


def write(spark, base: str):
    from brisa.plans.warehouse import Inputs

    os.makedirs(base, exist_ok=True)
    spark.createDataFrame(flights(), schemas.FLIGHTS_RAW).write.mode("overwrite").parquet(f"{base}/flights")
    spark.createDataFrame(weather(), schemas.WEATHER_RAW).write.mode("overwrite").parquet(f"{base}/weather")
    with open(f"{base}/airports.csv", "w", encoding="utf-8") as f:
        f.write(",".join(schemas.AIRPORTS_RAW.fieldNames()) + "\n")
        for r in AIRPORTS:
            f.write(",".join(f'"{x}"' for x in r) + "\n")
    for name, lines in (("airlines.dat", AIRLINES), ("routes.dat", ROUTES), ("seed.csv", SEED)):
        with open(f"{base}/{name}", "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    return Inputs(
        flights=f"{base}/flights",
        weather=f"{base}/weather",
        airports=f"{base}/airports.csv",
        airlines=f"{base}/airlines.dat",
        routes=f"{base}/routes.dat",
        hub_seed=f"{base}/seed.csv",
    )
