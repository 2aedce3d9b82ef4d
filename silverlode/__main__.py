"""Command line: ``python -m silverlode <job> --base <lake> ...``.

Sessions come from spark-submit or local defaults; storage settings are Spark
configuration, not arguments.
"""

from __future__ import annotations

import argparse
import datetime as dt

from silverlode.operators.versioned import VersionedTable
from silverlode.plans import build_gold, build_silver, ingest, run_batch
from silverlode.plans.upkeep import compact_tables, expire_tables, layer_metrics
from silverlode.session import open_session
from silverlode.sources import Layers, bus_stream
from silverlode.streaming import ingest_stream, windowed_stream
from silverlode.streaming.windows import LATENESS, WINDOW


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="silverlode", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, about: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=about)
        sub.add_argument("--base", required=True, help="root of the bronze, silver, gold and quarantine layers")
        return sub

    for name, about in (("ingest", "raw files into bronze"), ("batch", "raw files to gold")):
        sub = job(name, about)
        for entity in ("transactions", "customers", "products"):
            sub.add_argument(f"--{entity}", help=f"raw {entity} path")
        sub.add_argument("--format", default="csv", choices=["csv", "json", "parquet"])
        sub.add_argument("--full", action="store_true", help="judge all of bronze again")
    job("silver", "bronze into silver and quarantine").add_argument("--full", action="store_true")
    job("gold", "silver into gold").add_argument("--optimize", action="store_true")
    job("compact", "fewer, larger files in every layer")
    job("expire", "give up old versions").add_argument("--retention-hours", type=float, default=168)
    job("metrics", "rows written and rejected, per table and version")
    for name, about in (("history", "versions of a table"), ("restore", "make an old version current")):
        sub = job(name, about)
        sub.add_argument("--layer", required=True)
        sub.add_argument("--table", required=True)
        if name == "restore":
            sub.add_argument("--version", type=int, required=True)
    sub = job("stream", "events from a bus into bronze, or window totals of them")
    sub.add_argument("--servers", required=True)
    sub.add_argument("--topic", default="transactions")
    sub.add_argument("--checkpoint", required=True, help="a directory of this query's own")
    sub.add_argument("--aggregated", action="store_true")
    sub.add_argument("--window", default=WINDOW)
    sub.add_argument("--watermark", default=LATENESS)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark, layers = open_session(f"silverlode-{args.job}"), Layers(args.base)

    def table() -> VersionedTable:
        return VersionedTable(spark, layers.path(args.layer, args.table))

    if args.job in ("ingest", "batch"):
        inputs = {e: getattr(args, e) for e in ("transactions", "customers", "products") if getattr(args, e)}
        if args.job == "batch":
            print(run_batch(spark, inputs, args.base, incremental=not args.full, fmt=args.format))
        else:
            for entity, path in inputs.items():
                ingest(spark, path, layers, entity, fmt=args.format)
    elif args.job == "silver":
        print(build_silver(spark, layers, incremental=not args.full))
    elif args.job == "gold":
        print(build_gold(spark, layers, optimize=args.optimize))
    elif args.job == "compact":
        compact_tables(spark, layers).show(100, truncate=False)
    elif args.job == "expire":
        expire_tables(spark, layers, args.retention_hours, now=dt.datetime.now()).show(100, truncate=False)
    elif args.job == "metrics":
        layer_metrics(spark, layers).show(100, truncate=False)
    elif args.job == "history":
        table().history().show(100, truncate=False)
    elif args.job == "restore":
        print(table().restore(args.version))
    elif args.job == "stream":
        envelope = bus_stream(spark, args.servers, args.topic)
        if args.aggregated:
            query = windowed_stream(envelope, f"{layers.path('bronze')}/transactions_aggregated",
                                    args.checkpoint, args.window, args.watermark)
        else:
            query = ingest_stream(envelope, layers.path("bronze", "transactions"),
                                  args.checkpoint, args.watermark)
        query.awaitTermination()


if __name__ == "__main__":
    main()
