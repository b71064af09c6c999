"""Command line: ``python -m brisa <command> ...``.

Commands
  land-flights  SRC_GLOB OUT_DIR [--overwrite]   monthly gzip CSVs -> Parquet by month
  seed          FLIGHTS AIRPORTS OUT_CSV [--year Y] [--n N]   rank hubs, write the seed
  build         FLIGHTS WEATHER AIRPORTS AIRLINES ROUTES OUT_DIR [--seed CSV] [--weather-json]
                every model, the marts in the month layout, and the data-test summary
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run one command; a session passed in is used and left running."""
    ap = argparse.ArgumentParser(prog="brisa")
    sub = ap.add_subparsers(dest="cmd", required=True)
    lf = sub.add_parser("land-flights")
    lf.add_argument("src")
    lf.add_argument("out")
    lf.add_argument("--overwrite", action="store_true")
    sd = sub.add_parser("seed")
    sd.add_argument("flights")
    sd.add_argument("airports")
    sd.add_argument("out")
    sd.add_argument("--year", type=int, default=2019)
    sd.add_argument("--n", type=int, default=20)
    bd = sub.add_parser("build")
    for a in ("flights", "weather", "airports", "airlines", "routes", "out"):
        bd.add_argument(a)
    bd.add_argument("--seed")
    bd.add_argument("--weather-json", action="store_true")
    ap.add_argument("--master", help="only without spark-submit, e.g. local[*]")
    args = ap.parse_args(argv)

    from .session import build_session

    own = spark is None
    spark = spark or build_session(master=args.master)
    if args.cmd == "land-flights":
        from .sources.jobs import land_flight_files

        print(json.dumps({"rows_written": land_flight_files(spark, args.src, args.out, resume=not args.overwrite)}))
    elif args.cmd == "seed":
        from .plans.warehouse import build_hub_seed

        build_hub_seed(spark, args.flights, args.airports, args.out, year=args.year, n=args.n).show(args.n, truncate=False)
    else:
        from .plans.warehouse import Inputs, run

        inp = Inputs(
            flights=args.flights,
            weather=args.weather,
            airports=args.airports,
            airlines=args.airlines,
            routes=args.routes,
            hub_seed=args.seed,
            weather_format="json" if args.weather_json else "parquet",
        )
        build = run(spark, inp, args.out)
        build["quality_summary"].show()
        build["score_table"].show(truncate=False)
        build["stress_correlation"].show()
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
