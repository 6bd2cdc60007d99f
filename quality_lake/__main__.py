"""Command line: the whole run, one ingestion, or the integration.

    python -m quality_lake run --root warehouse --taxi 'data/yellow_tripdata_2024-*.parquet' \\
        --air-quality data/hourly_88101_2024.csv --weather data/weather.csv \\
        --zones data/taxi_zone_lookup.csv
    python -m quality_lake ingest data/weather.csv weather --root warehouse
    python -m quality_lake integrate --root warehouse

The contract argument is a shipped contract name or a JSON file.  The session
comes from ``SparkSession.builder.getOrCreate()``, so ``spark-submit`` options
and ``spark-defaults.conf`` apply.  Prints one JSON document.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from .contract import Contract, bundled_contract
from .plans.clean import ingest
from .plans.integrate import integrate
from .plans.warehouse import DATASETS, build_warehouse
from .plans.sizing import sized_session
from .sources.versions import read_table


def _contract(arg: str) -> Contract:
    return Contract.from_json(arg) if os.path.isfile(arg) else bundled_contract(arg)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m quality_lake")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="ingest every given source, then integrate")
    run.add_argument("--root", required=True)
    for role in DATASETS:
        run.add_argument(f"--{role.replace('_', '-')}", dest=role)
    run.add_argument("--format", default="parquet")
    one = sub.add_parser("ingest", help="clean one source into <root>/cleaned/<table>")
    one.add_argument("path")
    one.add_argument("contract")
    one.add_argument("--root", required=True)
    one.add_argument("--format", default="parquet")
    integ = sub.add_parser("integrate", help="integrate the cleaned tables under <root>")
    integ.add_argument("--root", required=True)
    integ.add_argument("--format", default="parquet")
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = _parser().parse_args(argv)
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName("quality_lake").getOrCreate()
    if args.command == "run":
        sources = {role: getattr(args, role) for role in DATASETS if getattr(args, role)}
        out = build_warehouse(spark, sources, args.root, fmt=args.format,
                              integrate_output=all(r in sources for r in DATASETS))
    elif args.command == "ingest":
        c = _contract(args.contract)
        out = ingest(spark, args.path, c, f"{args.root}/cleaned/{c.table_name}", fmt=args.format,
                     runs_path=f"{args.root}/metadata/ingestion_runs").record
    else:
        paths = {role: f"{args.root}/cleaned/{bundled_contract(name).table_name}" for role, name in DATASETS.items()}
        own = sized_session(spark, *paths.values()) if args.format == "parquet" else spark
        tables = {role: read_table(own, path, args.format) for role, path in paths.items()}
        out = integrate(tables, f"{args.root}/integrated/integrated_taxi_trips", fmt=args.format)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
