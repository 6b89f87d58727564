"""Incremental plans: per-batch deltas, folds, and a real streaming run.

``batch_deltas`` computes the delta rows of *every* micro-batch of a bounded
change table in one job (grouping by ``batch_id`` as well as REGION); it is
row-for-row what the stream's ``foreachBatch`` writes batch by batch, and lets
the folds be checked without running a stream. ``run_stream`` runs the real
stream over the same rows staged as files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.operators import deltas as delta_ops
from regiontally.operators.hierarchy import lookup_broadcastable, region_lookup, resolve_users
from regiontally.operators.report import mortality_report, report_base
from regiontally.streaming.delta_log import read_log
from regiontally.streaming.runner import ReportStream, log_sink, start_report_stream
from regiontally.streaming.staging import ChangeFeed

BATCH_KEY = "batch_id"
CONTINUOUS = {"processingTime": "0 seconds"}
STAGED_FIELDS = ["_id", "regionId", "districtId", "active"]


def batch_deltas(
    changes: DataFrame,
    regions: DataFrame,
    with_parent: bool = False,
    broadcast: bool | None = None,
) -> DataFrame:
    """Delta rows per ``(batch_id, REGION)`` of a bounded table of change rows."""
    small_tree = lookup_broadcastable(regions) if broadcast is None else broadcast
    resolved = resolve_users(changes, region_lookup(regions), carry=[BATCH_KEY], broadcast=small_tree)
    rows = delta_ops.deltas(resolved, report_base(regions), keys=[BATCH_KEY], bounded=small_tree)
    return rows if with_parent else rows.drop("parent_country_id_source")


def as_log(delta_rows: DataFrame, epoch: int = 0) -> DataFrame:
    """Delta rows with a ``batch_id`` as a log of one epoch."""
    return delta_rows.withColumn("epoch", F.expr(f"CAST({int(epoch)} AS BIGINT)"))


def merge_one_batch(users: DataFrame, regions: DataFrame, changes: DataFrame, batch_id: int = 0) -> DataFrame:
    """The batch report after upserting the deltas of micro-batch ``batch_id``."""
    small_tree = lookup_broadcastable(regions)
    one = changes.where(f"{BATCH_KEY} = {int(batch_id)}")
    log = as_log(batch_deltas(one, regions, with_parent=True, broadcast=small_tree))
    return delta_ops.fold(log, mortality_report(users, regions, broadcast=small_tree))


def report_after_stream(
    changes: DataFrame,
    regions: DataFrame,
    baseline: DataFrame | None = None,
    broadcast: bool | None = None,
) -> DataFrame:
    """The report after every micro-batch of ``changes``, over ``baseline`` (``None``: an empty table)."""
    log = as_log(batch_deltas(changes, regions, with_parent=True, broadcast=broadcast))
    return delta_ops.fold(log, baseline)


def run_stream(
    spark: SparkSession,
    raw_changes: DataFrame,
    regions: DataFrame,
    work_dir: str,
    epoch: int = 0,
) -> DataFrame:
    """Replay ``raw_changes`` (user documents + ``batch_id``) through the real stream and
    return the logged delta rows.

    The rows are staged once in parallel; each batch is then released into the
    watched folder and processed as exactly one micro-batch, in batch order, by
    one running query. ``work_dir`` must be shared storage (feed, checkpoint, log).
    """
    feed = ChangeFeed(spark, f"{work_dir}/feed", BATCH_KEY)
    # The report reads four fields of a change document; the stream declares the
    # full document schema, and fields absent from the staged files read as NULL,
    # so only those four are copied into the feed.
    batches = feed.stage(raw_changes.select(*STAGED_FIELDS, BATCH_KEY))
    checkpoint, log = f"{work_dir}/checkpoint", f"{work_dir}/log"
    handle = start_report_stream(feed.stream(), regions, log_sink(log), checkpoint, epoch, trigger=CONTINUOUS)
    deliver(feed, batches, handle)
    return read_log(spark, log)


def deliver(feed: ChangeFeed, batches: list[int], handle: ReportStream) -> None:
    """Release the pending batches one by one, each processed as one micro-batch, then stop the stream."""
    try:
        for batch in batches:
            feed.release(batch)
            handle.process_all_available()
    finally:
        handle.stop()
