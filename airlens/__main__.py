"""Command line for schedulers: ``python -m airlens <command> ...``.

Commands
  daily-air       ingest one day's CSV, rebuild every table, stop on CRITICAL
  daily-weather   store one day of a weather payload (Parquet), rebuild the weather tables
  backfill-weather  store every new day of a weather payload
  rebuild         rebuild every table from the stores
  sql             run a read-only query over the published tables of a rebuild folder
"""

from __future__ import annotations

import argparse
import json
import sys

from airlens.sources.schemas import COMMUNES, EPCI


def _session(args):
    from airlens.session import build_session, cluster_session
    return build_session(args.master) if args.master else cluster_session()


def _dims(spark, args):
    from airlens.sources.ingest import read_reference_csv
    return read_reference_csv(spark, args.communes, COMMUNES), read_reference_csv(spark, args.epci, EPCI)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="airlens")
    p.add_argument("--master", help="local master for a local run (default: from spark-submit)")
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("daily-air")
    a.add_argument("--csv", required=True)
    a.add_argument("--day", required=True)
    for name in ("air-store", "communes", "epci", "out"):
        a.add_argument(f"--{name}", required=True)
    a.add_argument("--weather-store")
    a.add_argument("--incremental", action="store_true", help="rebuild only what the new day changes")

    w = sub.add_parser("daily-weather")
    w.add_argument("--payload", required=True)
    w.add_argument("--centroids", required=True)
    w.add_argument("--day", required=True)
    w.add_argument("--weather-store", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--json")

    b = sub.add_parser("backfill-weather")
    b.add_argument("--payload", required=True)
    b.add_argument("--centroids", required=True)
    b.add_argument("--weather-store", required=True)
    b.add_argument("--json")

    r = sub.add_parser("rebuild")
    for name in ("air-store", "communes", "epci", "out"):
        r.add_argument(f"--{name}", required=True)
    r.add_argument("--weather-store")

    q = sub.add_parser("sql")
    q.add_argument("--out", required=True)
    q.add_argument("--csv", help="write the whole result there instead of printing it")
    q.add_argument("query")

    args = p.parse_args(argv)
    spark = _session(args)
    from airlens.plans import daily, rebuild, sqlapi
    from airlens.sources.ingest import read_centroids
    from airlens.sources.schemas import WEATHER_PAYLOAD
    from airlens.sources.store import open_table

    if args.cmd == "daily-air":
        communes, epci = _dims(spark, args)
        res = daily.daily_air_run(spark, args.csv, args.day, args.air_store, communes, epci, args.out,
                                  args.weather_store, incremental=args.incremental)
    elif args.cmd in ("daily-weather", "backfill-weather"):
        payload = spark.read.schema(WEATHER_PAYLOAD).parquet(args.payload)
        locations = read_centroids(spark, args.centroids)
        if args.cmd == "daily-weather":
            res = daily.daily_weather_run(spark, payload, locations, args.day, args.weather_store, args.out,
                                          args.json)
        else:
            res = daily.backfill_weather(spark, payload, locations, args.weather_store, args.json)
    elif args.cmd == "rebuild":
        communes, epci = _dims(spark, args)
        res = {"tables": sorted(rebuild.run_all(spark, args.air_store, args.weather_store, communes, epci,
                                                args.out))}
    else:
        tables = {}
        for name in sqlapi.PUBLISHED_VIEWS:
            try:
                tables[name] = open_table(spark, f"{args.out.rstrip('/')}/{name}")
            except FileNotFoundError:
                pass    # a table not built (no weather yet) is not published
        sqlapi.publish(tables)
        out = sqlapi.run_console(spark, args.query)
        res = {k: out[k] for k in ("ok", "columns", "n_rows", "n_columns", "error")}
        if out["ok"] and args.csv:
            sqlapi.export_result(out["data"], args.csv)
        elif out["ok"]:   # every row, one partition at a time
            for row in out["data"].toLocalIterator():
                print(json.dumps(list(map(str, row))))
    print(json.dumps(res, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
