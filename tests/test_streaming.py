"""The real stream: file source → foreachBatch → delta log → fold.

Covers one run, a restart that picks up newly arrived batches from the
checkpoint, a crash after the log write (batch replayed, counted once) and the
idempotent overwrite of one log entry.
"""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from regiontally.operators.deltas import fold
from regiontally.session import shared_dir
from regiontally.schemas import DELTA_SCHEMA
from regiontally.streaming import dead_letters
from regiontally.streaming.delta_log import read_log, write_batch
from regiontally.streaming.runner import log_sink, replay_dead_letters, start_report_stream
from regiontally.streaming.staging import ChangeFeed
from tests import fixtures as fx

CONTINUOUS = {"processingTime": "0 seconds"}


def _raw_changes(spark, batches):
    out = None
    for b in batches:
        rows = [(i, None, r, None, a) for bb, i, r, a in fx.STREAM_ROWS if bb == b]
        part = fx.raw_users(spark, rows).withColumn("batch_id", F.lit(b).cast("bigint"))
        out = part if out is None else out.unionByName(part)
    return out


def _state(df):
    return {r.region_id: (r.total_population, r.dead_population, r.mortality_rate_percent) for r in df.collect()}


def _start(spark, work, feed, after_batch=None):
    return start_report_stream(
        feed.stream(),
        fx.regions(spark),
        log_sink(f"{work}/log"),
        f"{work}/checkpoint",
        trigger=CONTINUOUS,
        after_batch=after_batch,
    )


def _feed(spark, work, batches):
    feed = ChangeFeed(spark, f"{work}/feed")
    assert feed.stage(_raw_changes(spark, batches)) == batches
    return feed


def _deliver(handle, feed, batches):
    for b in batches:
        feed.release(b)
        handle.process_all_available()


def _logged_batches(spark, work):
    return sorted(r.batch_id for r in read_log(spark, f"{work}/log").select("batch_id").distinct().collect())


def test_stream_run_matches_fold_of_expected(spark):
    work = shared_dir(spark, "test-stream")
    feed = _feed(spark, work, [1, 2, 3, 4])
    handle = _start(spark, work, feed)
    try:
        _deliver(handle, feed, [1, 2, 3, 4])
    finally:
        handle.stop()
    assert _logged_batches(spark, work) == [0, 1, 2, 3]
    assert _state(fold(read_log(spark, f"{work}/log"))) == fx.EXPECTED_AFTER_EMPTY


def test_restart_picks_up_new_batches_only(spark):
    work = shared_dir(spark, "test-stream")
    feed = _feed(spark, work, [1, 2, 3, 4])
    handle = _start(spark, work, feed)
    try:
        _deliver(handle, feed, [1, 2])
    finally:
        handle.stop()
    assert _logged_batches(spark, work) == [0, 1]
    handle = _start(spark, work, feed)  # same checkpoint: nothing is re-read
    try:
        _deliver(handle, feed, [3, 4])
    finally:
        handle.stop()
    assert _logged_batches(spark, work) == [0, 1, 2, 3]
    assert _state(fold(read_log(spark, f"{work}/log"))) == fx.EXPECTED_AFTER_EMPTY


def test_crash_after_log_write_replays_batch_once(spark):
    work = shared_dir(spark, "test-stream")
    feed = _feed(spark, work, [1, 2, 3, 4])
    crashed = []

    def crash_once(batch_id, n_delta_rows):
        if batch_id == 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("simulated failure after the log write, before the commit")

    handle = _start(spark, work, feed, after_batch=crash_once)
    try:
        with pytest.raises(Exception):
            _deliver(handle, feed, [1, 2])
    finally:
        handle.stop()
    assert crashed == [1]
    handle = _start(spark, work, feed)  # restart: the uncommitted batch 1 runs again
    try:
        handle.process_all_available()
        _deliver(handle, feed, [3, 4])
    finally:
        handle.stop()
    log = read_log(spark, f"{work}/log")
    assert _logged_batches(spark, work) == [0, 1, 2, 3]
    assert _state(fold(log)) == fx.EXPECTED_AFTER_EMPTY


def test_log_entry_overwrite_is_idempotent(spark):
    work = shared_dir(spark, "test-log")
    resolved_cols = ["effective_region_id", "effective_region_name", "total_population_change",
                     "dead_population_change", "parent_country_id_source"]
    first = spark.createDataFrame([("R1", "North", 5, 5, "C1")], resolved_cols)
    again = spark.createDataFrame([("R1", "North", 1, 0, "C1")], resolved_cols)
    assert write_batch(first, work, 0, 7) == 1
    assert write_batch(again, work, 0, 7) == 1
    rows = read_log(spark, work).collect()
    assert [(r.total_population_change, r.dead_population_change, r.batch_id) for r in rows] == [(1, 0, 7)]


def test_empty_log_reads_as_empty(spark):
    work = shared_dir(spark, "test-log")
    assert read_log(spark, work).count() == 0
    assert fold(read_log(spark, work)).count() == 0


def test_regions_reread_per_batch(spark):
    work = shared_dir(spark, "test-stream")
    feed = _feed(spark, work, [1, 2, 3, 4])
    reads = []

    def snapshot():
        reads.append(1)
        return fx.regions(spark)

    handle = start_report_stream(
        feed.stream(), snapshot, log_sink(f"{work}/log"), f"{work}/checkpoint", trigger=CONTINUOUS
    )
    try:
        _deliver(handle, feed, [1, 2, 3, 4])
    finally:
        handle.stop()
    assert len(reads) == 4  # one snapshot per micro-batch
    assert _state(fold(read_log(spark, f"{work}/log"))) == fx.EXPECTED_AFTER_EMPTY


def test_empty_region_snapshot_changes_nothing(spark):
    work = shared_dir(spark, "test-stream")
    feed = _feed(spark, work, [1, 2])
    empty = fx.regions(spark).where("1 = 0")
    handle = start_report_stream(feed.stream(), empty, log_sink(f"{work}/log"), f"{work}/checkpoint", trigger=CONTINUOUS)
    try:
        _deliver(handle, feed, [1, 2])
    finally:
        handle.stop()
    log = read_log(spark, f"{work}/log")
    assert log.count() == 0
    assert fold(log).count() == 0


def test_log_entry_of_a_batch_without_rows_replaces_an_earlier_attempt(spark):
    work = shared_dir(spark, "test-log")
    one = spark.createDataFrame([("R1", "North", 5, 5, "C1")], DELTA_SCHEMA)
    write_batch(one, work, 0, 7)
    assert write_batch(one.limit(0), work, 0, 7) == 0
    assert read_log(spark, work).count() == 0


def test_a_restart_keeps_its_epoch_and_a_new_checkpoint_takes_a_later_one(spark):
    work = shared_dir(spark, "test-epochs")
    for part, batches in (("a", [1, 2]), ("b", [3, 4])):
        feed = ChangeFeed(spark, f"{work}/feed-{part}")
        feed.stage(_raw_changes(spark, batches))
        for batch in batches:  # a restart between the batches
            feed.release(batch)
            handle = start_report_stream(
                feed.stream(), fx.regions(spark), log_sink(f"{work}/log"), f"{work}/ckpt-{part}", trigger={"availableNow": True}
            )
            handle.await_done()
    positions = sorted({(r.epoch, r.batch_id) for r in read_log(spark, f"{work}/log").collect()})
    assert [b for _, b in positions] == [0, 1, 0, 1] and len({e for e, _ in positions}) == 2
    assert _state(fold(read_log(spark, f"{work}/log"))) == fx.EXPECTED_AFTER_EMPTY


def _cached(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_a_query_that_dies_by_itself_frees_its_side_tables(spark):
    work = shared_dir(spark, "test-listener")
    feed = _feed(spark, work, [1, 2])

    def crash(batch_id, n_delta_rows):
        raise RuntimeError("simulated failure")

    before = _cached(spark)
    handle = _start(spark, work, feed, after_batch=crash)
    feed.release(1)
    with pytest.raises(Exception):
        handle.process_all_available()
    for _ in range(100):  # the listener runs after the query has ended
        if not handle.cached:
            break
        time.sleep(0.1)
    assert handle.cached == [] and _cached(spark) <= before
    handle.stop()
    assert handle.listener is None


def test_a_refused_batch_is_kept_reported_and_replayed(spark):
    work = shared_dir(spark, "test-letters")
    feed = _feed(spark, work, [1, 2, 3, 4])
    seen = []

    def refuse(batch, batch_id):
        if batch_id == 1:
            raise ValueError("bad batch")

    handle = start_report_stream(
        feed.stream(), fx.regions(spark), log_sink(f"{work}/log"), f"{work}/checkpoint", epoch=0, trigger=CONTINUOUS,
        after_batch=lambda b, n: seen.append((b, n)), check=refuse, dead_letters=f"{work}/letters",
    )
    try:
        _deliver(handle, feed, [1, 2, 3, 4])
    finally:
        handle.stop()
    assert [b for b, _ in seen] == [0, 1, 2, 3] and dict(seen)[1] == -1
    assert _logged_batches(spark, work) == [0, 2, 3]
    (kept,) = dead_letters.causes(spark, f"{work}/letters").collect()
    assert (kept.epoch, kept.batch_id) == (0, 1) and "bad batch" in kept.cause and kept.n_rows > 0
    for _ in range(2):  # replayed twice: the log entry is the same
        assert replay_dead_letters(spark, f"{work}/letters", fx.regions(spark), log_sink(f"{work}/log")) == [(0, 1)]
    assert _state(fold(read_log(spark, f"{work}/log"))) == fx.EXPECTED_AFTER_EMPTY


def test_a_failing_sink_fails_the_query_and_is_no_dead_letter(spark):
    work = shared_dir(spark, "test-letters")
    feed = _feed(spark, work, [1])

    def broken(rows, position):
        raise OSError("no space")

    handle = start_report_stream(
        feed.stream(), fx.regions(spark), broken, f"{work}/checkpoint", trigger=CONTINUOUS, dead_letters=f"{work}/letters"
    )
    try:
        with pytest.raises(Exception, match="no space"):
            _deliver(handle, feed, [1])
    finally:
        handle.stop()
    assert dead_letters.positions(spark, f"{work}/letters") == []
