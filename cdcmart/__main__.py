"""Command line of the mart: ``python -m cdcmart <command> --root <folder> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import sys

from pyspark.sql import DataFrame, SparkSession

from cdcmart.functions import codec
from cdcmart.operators import replay, reports, upsert
from cdcmart.plans import catalog, repair, reporting
from cdcmart.plans.incremental import MaintainedReports, refresh_after_commit
from cdcmart.session import build_session
from cdcmart.sinks import files
from cdcmart.sinks.external import catalog_table
from cdcmart.sinks.mart import Mart
from cdcmart.sources import changes, tables
from cdcmart.specs import SPECS, resolve
from cdcmart.streaming import batches, runner

AFTER_BATCH = {"sync": repair.sync_after_commit, "refresh": refresh_after_commit}

RANKED = {
    "top_delivery_dates": ("open_order_count", "delivery_date"),
    "top_customers": ("pending_order_count", "customer_id"),
}


def _names(given: list[str]) -> list[str]:
    """Mart table names for table arguments; ``all`` means every table."""
    if any(n.lower() == "all" for n in given):
        return list(SPECS)
    return [resolve(n).name for n in given]


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cdcmart", description=__doc__)
    parser.add_argument("--master", help="Spark master; default is the one spark-submit gives")
    parser.add_argument("--input-gib", type=int, help="data a job reads, to size its shuffles")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of the mart, on shared storage")
        sub.add_argument("--merge-into", metavar="TABLE=CATALOG_TABLE", nargs="*", default=[],
                         help="tables whose current state is a catalog table, kept by MERGE; the same for every command")
        return sub

    def with_tables(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--table", nargs="+", default=["all"], help="table names, or all")

    command("init", "commit an empty state for tables that have none")
    command("validate", "check that every table exists and has the right columns")

    sub = command("catalog", "create or move the catalog tables that show the newest states, and check them")
    sub.add_argument("--database", default=catalog.DATABASE)
    sub.add_argument("--fold", action="store_true", help="fold pending changes first")

    sub = command("stream", "keep tables current from the change log")
    with_tables(sub)
    sub.add_argument("--format", default="kafka", choices=["kafka", *changes.FILE_FORMATS])
    sub.add_argument("--bootstrap", help="Kafka bootstrap servers")
    sub.add_argument("--prefix", default="cdc", help="topic prefix")
    sub.add_argument("--schema", default="operations", help="source schema, second part of a topic")
    sub.add_argument("--path", help="folder with one sub-folder per source table, for file formats")
    sub.add_argument("--offset", type=replay.parse_position, default=replay.EARLIEST)
    sub.add_argument("--partitions", type=int, default=1, help="topic partitions, for a numeric offset")
    sub.add_argument("--max-offsets", type=int, default=5_000_000, help="largest batch, in log positions")
    sub.add_argument("--min-partitions", type=int, help="tasks a Kafka batch is split into at least")
    sub.add_argument("--max-files", type=int, default=1000, help="largest batch of a file log, in files")
    sub.add_argument("--trigger", default=runner.TRIGGER)
    sub.add_argument("--once", action="store_true", help="process what is there, then stop")
    sub.add_argument("--deletes", default="ignore", choices=["ignore", "soft"])
    sub.add_argument("--encoding", default=codec.CONNECT, choices=[codec.CONNECT, codec.ISO])
    sub.add_argument("--on-conflict", choices=[upsert.LAST_BATCH, upsert.NEWEST])

    sub.add_argument("--audit", action="store_true", help="keep offsets and unreadable records of every batch")
    sub.add_argument("--after-batch", nargs="*", default=[], choices=sorted(AFTER_BATCH),
                     help="sync: store the status of changed orders with their items; refresh: the maintained reports")

    sub = command("audit", "print lost offsets and unreadable records of audited streams")
    with_tables(sub)
    sub.add_argument("--show", type=int, default=20, help="rows of each to print")

    sub = command("report", "write whole reports and print where they are")
    sub.add_argument("--output", help="folder for them; default: reports, below the root")
    sub.add_argument("--show", type=int, help="also print the first so many rows of each")
    sub.add_argument("--name", nargs="+", default=sorted(reporting.REPORTS), choices=sorted(reporting.REPORTS))
    sub.add_argument("--top", type=int, default=3)

    sub = command("refresh", "bring the maintained reports up to date by what changed, and print them")
    sub.add_argument("--name", nargs="+", default=sorted(reporting.REPORTS), choices=sorted(reporting.REPORTS))
    sub.add_argument("--top", type=int, default=3)
    sub.add_argument("--show", type=int, default=20, help="rows of each to print")

    sub = command("backfill", "upsert a date range of a source table")
    sub.add_argument("--table", required=True)
    sub.add_argument("--from-date", required=True)
    sub.add_argument("--to-date", help="default: today")
    sub.add_argument("--source", help="Parquet folder of the source table")
    sub.add_argument("--url", help="JDBC url of the source database")
    sub.add_argument("--source-table", help="source table, with --url")
    sub.add_argument("--split-by", help="integer column to read over several connections, with --split-bounds")
    sub.add_argument("--split-bounds", type=int, nargs=2, metavar=("LOW", "HIGH"))
    sub.add_argument("--connections", type=int, help="connections, with --split-by")
    sub.add_argument("--property", nargs="*", default=[], metavar="NAME=VALUE", help="JDBC properties, as user and password")
    sub.add_argument("--rename", nargs="*", default=[], metavar="SOURCE=MART")
    sub.add_argument("--dry-run", action="store_true")

    sub = command("reset", "empty tables and their histories")
    with_tables(sub)
    sub.add_argument("--replay", action="store_true", help="read the log again as well")

    with_tables(command("replay", "let streams read the log again at their next start"))
    with_tables(command("merge", "fold the pending changes of tables among themselves"))
    with_tables(command("merge-history", "put the history of days that are over into one folder each"))
    with_tables(command("compact", "fold the changes of tables into their states"))
    sub = command("vacuum", "remove files that folds replaced long enough ago")
    with_tables(sub)
    sub.add_argument("--older-than-hours", type=float, default=24.0)
    command("sync", "store the present status of their orders with the order items")
    with_tables(command("status", "row counts, versions and checkpoints"))
    return parser


def _scan(spark: SparkSession, args: argparse.Namespace, name: str) -> DataFrame:
    source = SPECS[name].source
    if args.format != "kafka":
        options = {"path": f"{args.path}/{source}", "maxFilesPerTrigger": str(args.max_files)}
        return replay.replay_from(changes.change_stream(spark, args.format, options), args.offset, "offset")
    topic = changes.topic_name(args.prefix, args.schema, source)
    start = replay.starting_offsets(topic, args.offset, range(args.partitions))
    options = changes.kafka_options(
        args.bootstrap,
        topic,
        start,
        max_offsets_per_trigger=args.max_offsets,
        min_partitions=args.min_partitions,
    )
    return changes.change_stream(spark, "kafka", options)


def _stream(mart: Mart, args: argparse.Namespace) -> None:
    mart.create(deletes=args.deletes, encoding=args.encoding)
    names = _names(args.table)
    for name in names:
        # A checkpoint goes on from where it is; a start position would be ignored without a word.
        if args.offset != replay.EARLIEST and files.exists(mart.spark, f"{mart.checkpoint(name)}/metadata"):
            raise SystemExit(f"{name}: --offset has no effect on a stream that has started; run replay first")

    def after(mart: Mart, name: str, version: int) -> None:
        for word in sorted(args.after_batch, reverse=True):  # the reports see what the sync has stored
            AFTER_BATCH[word](mart, name, version)

    options = {"deletes": args.deletes, "encoding": args.encoding, "audit": args.audit, "on_commit": after}
    scans = {n: _scan(mart.spark, args, n) for n in names}
    if not args.once:
        runner.run_all(mart, scans, trigger=args.trigger, **options)
        return
    for name, scan in scans.items():
        query = runner.start_mart_stream(mart, name, scan, trigger=None, **options)
        query.awaitTermination()


def _backfill(mart: Mart, args: argparse.Namespace) -> None:
    if args.url:
        source = tables.jdbc_table(
            mart.spark,
            url=args.url,
            table=args.source_table,
            properties=dict(p.split("=", 1) for p in args.property),
            key=args.split_by,
            bounds=tuple(args.split_bounds) if args.split_bounds else None,
            partitions=args.connections,
        )
    else:
        source = tables.file_table(mart.spark, args.source)
    renames = dict(r.split("=", 1) for r in args.rename)
    done = repair.backfill(
        mart, args.table, source, args.from_date, args.to_date, args.dry_run, renames=renames
    )
    print(done.plan or "", end="")
    print(json.dumps({k: v for k, v in vars(done).items() if k != "plan"}))


def _report(mart: Mart, args: argparse.Namespace) -> None:
    for name, path in reporting.publish(mart, args.name, args.top, args.output).items():
        print(json.dumps({"report": name, "path": path}))
        if args.show:
            report = mart.spark.read.parquet(path).drop("contract_version", "generated_at")
            if name in RANKED:
                report = reports.with_rank(report, *RANKED[name])
            print(f"the first {args.show} rows:")
            report.show(args.show, truncate=False)


def _refresh(mart: Mart, args: argparse.Namespace) -> None:
    maintained = MaintainedReports(mart)
    done = maintained.refresh()
    print(json.dumps({"refreshed": done is not None, "whole": bool(done and done.whole)}))
    maintained.clean()
    for name in args.name:
        print(name)
        maintained.report(name, args.top).show(args.show, truncate=False)


def _audit(mart: Mart, args: argparse.Namespace) -> None:
    for name in _names(args.table):
        for kind, rows in (("lost offsets", batches.lost_offsets(mart, name)), ("unreadable", batches.unreadable(mart, name))):
            if rows is not None:
                print(json.dumps({"table": name, kind: rows.count()}))
                rows.show(args.show, truncate=False)


def _status(mart: Mart, args: argparse.Namespace) -> None:
    for name in _names(args.table):
        table = mart.table(name)
        line = {
            "table": name,
            "rows": mart.current(name).count(),
            "version": table.latest_version(),
            "generation": table.generation(),
            "checkpoint": runner.checkpoint_status(mart.spark, mart.checkpoint(name)),
        }
        print(json.dumps(line))


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    size = args.input_gib * 1024**3 if args.input_gib else None
    spark = build_session(master=args.master, input_bytes=size)
    mart = Mart(spark, args.root, on_conflict=getattr(args, "on_conflict", None))
    for given in args.merge_into:
        name, table = given.split("=", 1)
        kept = mart.table(name)
        mart.outside[kept.spec.name] = catalog_table(spark, table, kept.spec, kept.on_conflict)
    if args.command == "init":
        mart.create()
    elif args.command == "validate":
        mart.validate()
    elif args.command == "catalog":
        print(json.dumps(catalog.register(mart, args.database, args.fold)))
        catalog.validate(mart, args.database)
    elif args.command == "stream":
        _stream(mart, args)
    elif args.command == "report":
        _report(mart, args)
    elif args.command == "audit":
        _audit(mart, args)
    elif args.command == "refresh":
        _refresh(mart, args)
    elif args.command == "backfill":
        _backfill(mart, args)
    elif args.command == "reset":
        for name in _names(args.table):
            print(json.dumps(repair.reset_table(mart, name, args.replay)))
    elif args.command == "replay":
        print(json.dumps(repair.request_replay(mart, *_names(args.table))))
    elif args.command == "compact":
        for name in _names(args.table):
            print(json.dumps({"table": name, "version": mart.table(name).rewrite()}))
    elif args.command == "merge":
        for name in _names(args.table):
            print(json.dumps({"table": name, "version": mart.table(name).merge()}))
    elif args.command == "vacuum":
        age = dt.timedelta(hours=args.older_than_hours)
        for name in _names(args.table):
            print(json.dumps({"table": name, "removed": mart.table(name).vacuum(age)}))
    elif args.command == "merge-history":
        for name in _names(args.table):
            print(json.dumps({"table": name, "days": mart.table(name).merge_history()}))
    elif args.command == "sync":
        print(json.dumps({"version": repair.sync_status(mart)}))
    elif args.command == "status":
        _status(mart, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
