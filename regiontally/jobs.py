"""The two jobs, end to end: batch full refresh and the incremental stream.

Both keep catalog tables. The batch job replaces a report table (a new version,
then a switch) or refreshes the bucketed table of the stream; the stream upserts
every micro-batch into that table, or logs its delta rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regiontally.operators.deltas import fold
from regiontally.operators.report import mortality_report, top_regions
from regiontally.schemas import REPORT_COLUMNS
from regiontally.sinks.tables import create_report_if_absent, full_name, merge_deltas, replace_report
from regiontally.sinks.upsert import DEFAULT_BUCKETS, REPLAY, UpsertTable
from regiontally.streaming.delta_log import read_log
from regiontally.streaming.runner import (
    DEFAULT_TRIGGER,
    TREE_COLUMNS,
    ReportStream,
    log_sink,
    merge_sink,
    replay_dead_letters,
    start_report_stream,
    table_sink,
)

STATS_ROWS = 20


def run_batch_job(
    spark: SparkSession,
    users: DataFrame,
    regions: DataFrame,
    table: str | None = None,
    target: UpsertTable | None = None,
    provider: str = "parquet",
    location: str | None = None,
) -> DataFrame:
    """Recompute the report from the full collections and publish it; returns the published rows.

    ``table`` is replaced by it (:func:`regiontally.sinks.tables.replace_report`);
    with ``target`` the bucketed table takes it as its new contents, and the batches
    applied so far count as contained. With neither the report is only returned.
    """
    # The tree is read by the size bound and by several lookup branches: cache its
    # four used columns once (a remote document source is then read once).
    tree = regions.select(*TREE_COLUMNS).persist()
    try:
        report = mortality_report(users, tree)
        if target is not None:
            target.refresh(report)
            report = target.report(spark)
        if table is not None:
            replace_report(report, table, provider=provider, location=location)
            report = spark.table(full_name(table)).select(*REPORT_COLUMNS)
    finally:
        tree.unpersist()
    return report


def logged_report(spark: SparkSession, log: str, baseline: DataFrame | None = None, rate_arithmetic: str = "double") -> DataFrame:
    """The report now: ``baseline`` with every batch of the log folded in."""
    return fold(read_log(spark, log), baseline, rate_arithmetic=rate_arithmetic)


def report_stats(spark: SparkSession, table: str, n: int = STATS_ROWS) -> DataFrame:
    """Top ``n`` REGIONs (rate, then total, then id) of ``table``, read by its name as it is now."""
    spark.catalog.refreshTable(full_name(table))
    return top_regions(spark.table(full_name(table)), n)


def run_stream_job(
    spark: SparkSession,
    users_stream: DataFrame,
    regions: DataFrame | Callable[[], DataFrame],
    checkpoint_location: str,
    table: str | None = None,
    log: str | None = None,
    sink: str = "upsert",
    buckets: int = DEFAULT_BUCKETS,
    epoch: int | None = None,
    trigger: dict | None = None,
    provider: str = "parquet",
    location: str | None = None,
    on_stats: Callable[[int, DataFrame], None] | None = None,
    max_broadcast_bytes: int | None = None,
    check: Callable[[DataFrame, int], None] | None = None,
    dead_letters: str | None = None,
    rate_arithmetic: str = "double",
) -> ReportStream:
    """Start the incremental report.

    ``sink="upsert"`` (the default) keeps ``table`` current, a bucketed table that is
    created if absent; ``"merge"`` upserts into a ``table`` of a catalog with
    row-level operations; ``"log"`` writes the delta rows under ``log``. After each
    batch that changed something, while the region tree is empty, and after a batch
    that went to ``dead_letters``, ``on_stats(batch_id, top20)`` receives the top 20
    (read from ``table`` by its name, or folded from ``log``).
    """
    if sink not in ("upsert", "merge", "log"):
        raise ValueError(f"unknown sink {sink!r}")
    if (log if sink == "log" else table) is None:
        raise ValueError(f"sink={sink!r} needs a {'log' if sink == 'log' else 'table'}")
    if sink == "upsert":
        target = UpsertTable.create(
            spark, table, buckets, provider=provider, location=location, rate_arithmetic=rate_arithmetic
        )
        to = table_sink(target)
    elif sink == "merge":
        create_report_if_absent(spark, table, provider=provider, location=location)
        to = merge_sink(lambda rows: merge_deltas(rows, table))
    else:
        to = log_sink(log)

    def after_batch(batch_id: int, n_delta_rows: int) -> None:
        top = top_regions(logged_report(spark, log), STATS_ROWS) if sink == "log" else report_stats(spark, table)
        on_stats(batch_id, top)

    return start_report_stream(
        users_stream,
        regions,
        to,
        checkpoint_location,
        epoch=epoch,
        trigger=trigger or DEFAULT_TRIGGER,
        max_broadcast_bytes=max_broadcast_bytes,
        after_batch=after_batch if on_stats is not None else None,
        check=check,
        dead_letters=dead_letters,
    )


def replay_into_table(
    spark: SparkSession,
    dead_letters: str,
    regions: DataFrame,
    target: UpsertTable,
    mend: Callable[[DataFrame], DataFrame] | None = None,
) -> list[tuple[int, int]]:
    """Replay the dead letters that ``target`` has not taken yet; the stream must not run meanwhile."""
    return replay_dead_letters(
        spark, dead_letters, regions, table_sink(target, REPLAY), after=target.position(spark, REPLAY), mend=mend
    )
