"""Command line: ``python -m regiontally {batch,stream,report,replay} ...``.

Sources are read with a format name and options (``--users-format <connector>
--users-option key=value ...`` for a document-store connector where it is
installed; parquet or json paths otherwise). Tables are named in the session's
catalog; with ``--location`` they live in, and are found again in, a folder of
shared storage. Checkpoints, logs and dead letters must be on shared storage.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from regiontally.jobs import replay_into_table, report_stats, run_batch_job, run_stream_job
from regiontally.operators.report import order_report
from regiontally.sources.readers import read_regions, read_users, stream_users
from regiontally.sinks.upsert import DEFAULT_BUCKETS, UpsertTable


def _options(pairs):
    return dict(p.split("=", 1) for p in pairs or [])


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="regiontally")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("batch", "stream", "replay"):
        p = sub.add_parser(name)
        if name != "replay":
            p.add_argument("--users", help="users path (omit for connector sources)")
            p.add_argument("--users-format", default="parquet")
            p.add_argument("--users-option", action="append")
        p.add_argument("--regions", help="regions path")
        p.add_argument("--regions-format", default="parquet")
        p.add_argument("--regions-option", action="append")
    for name in ("batch", "stream", "replay", "report"):
        p = sub.choices.get(name) or sub.add_parser(name)
        p.add_argument("--table", required=(name != "stream"), help="catalog table, namespace.name")
        p.add_argument("--location", help="folder of the table")
        p.add_argument("--provider", default="parquet")
        p.add_argument("--buckets", type=int, default=DEFAULT_BUCKETS, help="of a table that is created")
    batch = sub.choices["batch"]
    batch.add_argument("--bucketed", action="store_true", help="refresh the stream's bucketed table")
    stream = sub.choices["stream"]
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--epoch", type=int, default=None, help="default: the checkpoint's creation time")
    stream.add_argument("--trigger-seconds", type=int, default=30)
    stream.add_argument("--available-now", action="store_true")
    stream.add_argument("--stats", action="store_true", help="print the top 20 after each batch")
    stream.add_argument("--sink", choices=("upsert", "merge", "log"), default="upsert")
    stream.add_argument("--log", help="folder of the delta log (--sink log)")
    stream.add_argument("--dead-letters", help="folder for failed batches; without it a failed batch ends the stream")
    sub.choices["replay"].add_argument("--dead-letters", required=True)
    sub.choices["report"].add_argument("--top", type=int, default=20)
    return ap


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"regiontally-{args.cmd}").getOrCreate()
    if args.cmd != "report":
        regions = read_regions(spark, args.regions_format, args.regions, _options(args.regions_option))

    def bucketed() -> UpsertTable:
        return UpsertTable.create(spark, args.table, args.buckets, provider=args.provider, location=args.location)

    if args.cmd == "batch":
        users = read_users(spark, args.users_format, args.users, _options(args.users_option))
        if args.bucketed:
            published = run_batch_job(spark, users, regions, target=bucketed())
        else:
            published = run_batch_job(spark, users, regions, args.table, provider=args.provider, location=args.location)
        order_report(published).show(20, truncate=False)
    elif args.cmd == "stream":
        changes = stream_users(spark, args.users_format, args.users, _options(args.users_option))
        trigger = {"availableNow": True} if args.available_now else {"processingTime": f"{args.trigger_seconds} seconds"}
        on_stats = (lambda batch_id, top: top.show(truncate=False)) if args.stats else None
        handle = run_stream_job(
            spark, changes, regions, args.checkpoint, args.table, args.log, args.sink, args.buckets, args.epoch,
            trigger, args.provider, args.location, on_stats, dead_letters=args.dead_letters,
        )
        handle.await_done()
    elif args.cmd == "replay":
        print(len(replay_into_table(spark, args.dead_letters, regions, bucketed())), "batches replayed")
    elif args.cmd == "report":
        if args.location:
            bucketed()
        report_stats(spark, args.table, args.top).show(args.top, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
