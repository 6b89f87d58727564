"""The incremental report: a stream of user changes folded into per-REGION deltas.

``start_report_stream`` wires a streaming DataFrame of user documents to a
``foreachBatch`` callback. The region snapshot is read once, flattened into the
lookup and cached for the life of the stream (a stream-static join, as a
snapshot of a slowly changing dimension); pass a function as ``regions`` to
re-read it per batch instead. The broadcast decision is taken once, on a
proven bound of the lookup size computed from the snapshot. What is cached is
released when the query ends, by :meth:`ReportStream.stop` or by itself.

Per micro-batch: resolve (one join), ``distinct`` + one conditional aggregate,
name join on the aggregated rows, and a sink: the bucketed table
(:mod:`regiontally.sinks.upsert`), the delta log or a ``MERGE``. A batch of which
no user resolves changes nothing and reports nothing; an empty region snapshot
only reports.

A batch that fails fails the query, and a restart from the checkpoint replays
it, which both the log and the table take without counting twice. With
``dead_letters`` a batch whose delta rows cannot be computed is kept there with
its cause instead, the statistics are reported and the stream goes on; a sink
that fails fails the query all the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from regiontally.operators.deltas import deltas
from regiontally.operators.hierarchy import lookup_broadcastable, region_lookup, resolve_users
from regiontally.operators.report import report_base
from regiontally.sinks.upsert import STREAM, UpsertTable
from regiontally.streaming import dead_letters as letters
from regiontally.streaming.delta_log import checkpoint_epoch, write_batch

DEFAULT_TRIGGER = {"processingTime": "30 seconds"}
TREE_COLUMNS = ["region_doc_id", "region_name", "region_type", "parentRegionId"]

#: Takes the delta rows of one batch and its position; returns how many delta rows it was given.
Sink = Callable[[DataFrame, tuple[int, int]], int]


def log_sink(root: str) -> Sink:
    """Write the delta rows as the batch's entry of the delta log."""
    return lambda rows, position: write_batch(rows, root, *position)


def table_sink(target: UpsertTable, lane: str = STREAM) -> Sink:
    """Upsert the delta rows into the bucketed table."""
    return lambda rows, position: target.upsert(rows, position, lane)[0]


def merge_sink(merge: Callable[[DataFrame], None]) -> Sink:
    """``merge(delta_rows)``, for tables with row-level operations; a replayed batch adds twice."""

    def run(rows: DataFrame, position: tuple[int, int]) -> int:
        rows = rows.persist()
        try:
            n = rows.count()
            if n:
                merge(rows)
            return n
        finally:
            rows.unpersist()

    return run


class _ReleaseOnEnd(StreamingQueryListener):
    """Releases a stream's side tables when its query ends, also when it fails by itself."""

    def __init__(self, stream: ReportStream):
        self.stream = stream

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == str(self.stream.query.runId):
            self.stream.release()


@dataclass
class ReportStream:
    """A running report stream and the side tables it keeps cached."""

    query: StreamingQuery
    spark: SparkSession
    cached: list[DataFrame] = field(default_factory=list)
    listener: StreamingQueryListener | None = None

    def watch(self) -> ReportStream:
        self.listener = _ReleaseOnEnd(self)
        self.spark.streams.addListener(self.listener)
        if not self.query.isActive:  # it ended before the listener was there
            self.release()
        return self

    def stop(self) -> None:
        try:
            self.query.stop()
        finally:
            self.release()
            if self.listener is not None:
                self.spark.streams.removeListener(self.listener)
                self.listener = None

    def release(self) -> None:
        while self.cached:
            self.cached.pop().unpersist()

    def process_all_available(self) -> None:
        """Block until everything the source has now is processed and committed (raises its error)."""
        self.query.processAllAvailable()

    def await_done(self, timeout: float | None = None) -> bool:
        """Wait for a bounded trigger (``availableNow``) to finish; raise the query's error."""
        try:
            finished = self.query.awaitTermination(timeout)
        finally:
            if not self.query.isActive:
                self.release()
        return bool(finished) if timeout is not None else True


def batch_deltas(batch: DataFrame, lookup: DataFrame, base: DataFrame, broadcast: bool) -> DataFrame:
    """The delta rows of one micro-batch."""
    return deltas(resolve_users(batch, lookup, broadcast=broadcast), base, bounded=broadcast)


def batch_callback(
    lookup: DataFrame,
    base: DataFrame,
    sink: Sink,
    epoch: int | Callable[[], int],
    broadcast: bool,
    after_batch: Callable[[int, int], None] | None = None,
    check: Callable[[DataFrame, int], None] | None = None,
    dead_letters: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: one micro-batch → its delta rows into ``sink``.

    ``after_batch(batch_id, n_delta_rows)`` runs after the sink and before Spark
    commits the batch (for metrics or readbacks); if it raises, the batch is not
    committed and is replayed on restart. It is called for a batch with delta
    rows, for any batch while the region tree is empty, and for a batch that went
    to ``dead_letters`` (with -1). ``check(batch, batch_id)`` may reject a batch by
    raising. With ``dead_letters`` the delta rows are computed (and cached) before
    the sink runs, so that only a batch at fault, never a failing sink, is put aside.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        position = (epoch() if callable(epoch) else epoch, batch_id)
        if dead_letters is None:
            if check is not None:
                check(batch, batch_id)
            n = sink(batch_deltas(batch, lookup, base, broadcast), position)
        else:
            rows = batch_deltas(batch, lookup, base, broadcast).persist()
            try:
                try:
                    if check is not None:
                        check(batch, batch_id)
                    rows.count()
                except Exception as error:
                    letters.bury(batch, dead_letters, *position, error)
                    n = -1
                else:
                    n = sink(rows, position)
            finally:
                rows.unpersist()
        if after_batch is not None and (n != 0 or base.isEmpty()):
            after_batch(batch_id, n)

    return process


def start_report_stream(
    users_stream: DataFrame,
    regions: DataFrame | Callable[[], DataFrame],
    sink: Sink,
    checkpoint_location: str,
    epoch: int | None = None,
    trigger: dict | None = None,
    max_broadcast_bytes: int | None = None,
    query_name: str | None = None,
    after_batch: Callable[[int, int], None] | None = None,
    check: Callable[[DataFrame, int], None] | None = None,
    dead_letters: str | None = None,
) -> ReportStream:
    """Start the stream. ``regions`` is a snapshot, or a function re-read for every batch.

    ``epoch`` orders checkpoints that write to one target (each new checkpoint
    restarts ``batch_id`` at 0); it defaults to the creation time of the checkpoint
    (:func:`regiontally.streaming.delta_log.checkpoint_epoch`).
    """
    spark = users_stream.sparkSession
    at = (lambda: checkpoint_epoch(spark, checkpoint_location)) if epoch is None else epoch
    cached: list[DataFrame] = []
    if callable(regions):
        refresh = regions

        def process(batch: DataFrame, batch_id: int) -> None:
            # one read of the live tree per batch: the bound, the lookup and the names see the same rows
            current = refresh().select(*TREE_COLUMNS).persist()
            try:
                broadcast = lookup_broadcastable(current, max_broadcast_bytes)
                lookup, base = region_lookup(current), report_base(current)
                batch_callback(lookup, base, sink, at, broadcast, after_batch, check, dead_letters)(batch, batch_id)
            finally:
                current.unpersist()

    else:
        broadcast = lookup_broadcastable(regions, max_broadcast_bytes)
        lookup, base = region_lookup(regions).persist(), report_base(regions).persist()
        cached.extend([lookup, base])
        process = batch_callback(lookup, base, sink, at, broadcast, after_batch, check, dead_letters)

    writer = (
        users_stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**(trigger or DEFAULT_TRIGGER))
    )
    if query_name:
        writer = writer.queryName(query_name)
    return ReportStream(writer.start(), spark, cached).watch()


def replay_dead_letters(
    spark: SparkSession,
    root: str,
    regions: DataFrame,
    sink: Sink,
    after: tuple[int, int] = (-1, -1),
    max_broadcast_bytes: int | None = None,
    mend: Callable[[DataFrame], DataFrame] | None = None,
) -> list[tuple[int, int]]:
    """Run the kept batches after ``after`` through the same steps into ``sink``; returns their positions.

    With the log as sink a batch takes the place it would have had; with the table
    use its ``replay`` lane, which the stream's later batches do not fence off.
    ``mend`` maps the kept rows to sound ones where the rows were at fault.
    """
    broadcast = lookup_broadcastable(regions, max_broadcast_bytes)
    lookup, base = region_lookup(regions).persist(), report_base(regions).persist()

    def apply(rows: DataFrame, position: tuple[int, int]) -> None:
        sink(batch_deltas(mend(rows) if mend else rows, lookup, base, broadcast), position)

    try:
        return letters.replay(spark, root, apply, after)
    finally:
        lookup.unpersist()
        base.unpersist()
