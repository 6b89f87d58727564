"""Batch and stream jobs over catalog tables: refresh, upsert, replay, dead letters, CLI."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from regiontally.__main__ import main as cli
from regiontally.jobs import logged_report, replay_into_table, report_stats, run_batch_job, run_stream_job
from regiontally.plans.incremental import CONTINUOUS
from regiontally.schemas import DELTA_SCHEMA, REPORT_SCHEMA
from regiontally.session import shared_dir
from regiontally.sinks.tables import current_location, drop_old_versions, full_name, replace_report
from regiontally.sinks.upsert import REPLAY, UpsertTable
from regiontally.streaming.delta_log import read_log
from regiontally.streaming.runner import batch_callback, log_sink, table_sink
from regiontally.streaming.staging import ChangeFeed
from tests import fixtures as fx
from tests.test_streaming import _deliver, _raw_changes

GOLDEN = {r[0]: (r[3], r[4], r[5]) for r in fx.EXPECTED_REPORT}


def _state_of(df):
    return {r.region_id: (r.total_population, r.dead_population, r.mortality_rate_percent) for r in df.collect()}


@pytest.fixture
def work(spark):
    return shared_dir(spark, "test-jobs")


@pytest.fixture
def name(spark, work):
    return f"jobs.report_{work.rsplit('/', 1)[1][:10]}"


def _deltas(spark, *rows):
    return spark.createDataFrame([(r, f"name {r}", total, dead, f"C {r}") for r, total, dead in rows], DELTA_SCHEMA)


def _report(spark, rows):
    return spark.createDataFrame([(r, r, "REGION", None, t, d, 100.0 * d / t) for r, t, d in rows], REPORT_SCHEMA)


def _feed(spark, work, batches):
    feed = ChangeFeed(spark, f"{work}/feed")
    feed.stage(_raw_changes(spark, batches))
    return feed


def test_upsert_matches_inserts_and_keeps_untouched_rows(spark, work, name):
    target = UpsertTable.create(spark, name, buckets=4, location=f"{work}/t")
    target.refresh(_report(spark, [("R1", 4, 1), ("R2", 10, 1)]))
    assert target.upsert(_deltas(spark, ("R1", 9, 2), ("R3", 5, 5)), (0, 0)) == (2, 2)
    rows = {r.region_id: r for r in target.report(spark).collect()}
    assert (rows["R1"].total_population, rows["R1"].dead_population, rows["R1"].mortality_rate_percent) == (4, 3, 75.0)
    assert (rows["R1"].region_name, rows["R1"].parent_country_id) == ("R1", None)  # frozen
    assert (rows["R3"].region_name, rows["R3"].parent_country_id, rows["R3"].mortality_rate_percent) == ("name R3", "C R3", 100.0)
    assert _state_of(target.report(spark))["R2"] == (10, 1, 10.0)
    assert target.position(spark) == (0, 0)


def test_a_replayed_batch_changes_nothing_also_after_half_of_it_was_applied(spark, work, name):
    target = UpsertTable.create(spark, name, buckets=8, location=f"{work}/t")
    batch = _deltas(spark, *[(f"R{i}", 10, 1) for i in range(6)])
    target.upsert(batch.where("effective_region_id < 'R3'"), (0, 0))  # a first attempt got so far
    assert target.upsert(batch, (0, 0)) == (6, 3)
    assert target.upsert(batch, (0, 0)) == (6, 0)
    assert target.upsert(batch, (-1, 7)) == (6, 0)  # an older checkpoint's batch
    assert {v[:2] for v in _state_of(target.report(spark)).values()} == {(10, 1)}
    assert target.upsert(batch, (1, 0)) == (6, 6)  # a new checkpoint's first batch
    assert {v[:2] for v in _state_of(target.report(spark)).values()} == {(10, 2)}


def test_only_touched_buckets_are_rewritten(spark, work, name):
    target = UpsertTable.create(spark, name, buckets=8, location=f"{work}/t")
    target.refresh(_report(spark, [(f"R{i}", 10, 1) for i in range(30)]))
    files = lambda: {r.f for r in target.rows(spark).select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    target.upsert(_deltas(spark, ("R7", 1, 1)), (0, 0))
    assert len(before) == len(files()) and len(before - files()) == 1
    assert target.upsert(_deltas(spark, ("R7", 1, 1)).limit(0), (0, 1)) == (0, 0)


def test_a_null_region_and_null_fences_are_handled(spark, work, name):
    target = UpsertTable.create(spark, name, buckets=2, location=f"{work}/t")
    rows = spark.createDataFrame([(None, "n", "REGION", None, 3, 1, 33.0), ("R1", "a", "REGION", None, 0, 0, 0.0)], REPORT_SCHEMA)
    target.refresh(rows)
    target.upsert(_deltas(spark, ("R1", 5, 2)), (0, 0))
    got = _state_of(target.report(spark))
    assert got == {None: (3, 1, 33.0), "R1": (0, 2, 0.0)}  # total 0: rate 0


def test_refresh_drops_buckets_without_rows_and_a_failed_one_changes_nothing(spark, work, name):
    target = UpsertTable.create(spark, name, buckets=8, location=f"{work}/t")
    target.refresh(_report(spark, [(f"R{i}", 10, 1) for i in range(20)]))
    broken = _report(spark, [("R1", 9, 9)]).withColumn("region_name", F.expr("raise_error(concat('broken ', region_id))"))
    with pytest.raises(Exception, match="broken"):
        target.refresh(broken)
    assert len(_state_of(target.report(spark))) == 20
    target.upsert(_deltas(spark, ("R3", 1, 1)), (2, 5))
    target.refresh(_report(spark, [("R3", 7, 0)]))
    assert _state_of(target.report(spark)) == {"R3": (7, 0, 0.0)}
    assert target.upsert(_deltas(spark, ("R3", 1, 1)), (2, 5)) == (1, 0)  # contained in the refresh


def test_a_table_is_found_again_in_its_folder(spark, work, name):
    target = UpsertTable.create(spark, name, buckets=4, location=f"{work}/t")
    target.upsert(_deltas(spark, ("R1", 4, 1)), (0, 0))
    again = UpsertTable.create(spark, f"{name}_again", buckets=4, location=f"{work}/t")
    assert _state_of(again.report(spark)) == {"R1": (4, 1, 25.0)}
    assert UpsertTable.create(spark, name, buckets=99).buckets == 4


def test_replace_switches_versions_and_a_failed_write_keeps_the_rows(spark, work, name):
    replace_report(_report(spark, [("R1", 4, 1)]), name, location=f"{work}/t")
    first = current_location(spark, name)
    planned = spark.table(full_name(name))
    broken = _report(spark, [("R1", 9, 9)]).withColumn("region_name", F.expr("raise_error(concat('broken ', region_id))"))
    with pytest.raises(Exception, match="broken"):
        replace_report(broken, name, location=f"{work}/t")
    assert current_location(spark, name) == first
    own = spark.table(full_name(name)).withColumn("dead_population", F.col("dead_population") + 1)
    replace_report(own, name, location=f"{work}/t")  # a report computed from the table itself
    assert _state_of(spark.table(full_name(name)))["R1"][:2] == (4, 2)
    assert _state_of(planned)["R1"][:2] == (4, 1)  # planned before the switch
    dropped = drop_old_versions(spark, name, keep=0)
    assert any(d.endswith(first.rsplit("/", 1)[1]) for d in dropped)
    assert _state_of(spark.table(full_name(name)))["R1"][:2] == (4, 2)


def test_replace_without_a_location_uses_the_namespace(spark, work):
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS spark_catalog.homed LOCATION '{work}/homed'")
    for dead in (1, 2):
        replace_report(_report(spark, [("R1", 4, dead)]), "homed.report")
        assert _state_of(spark.table("spark_catalog.homed.report"))["R1"][1] == dead
    assert "/homed/report/version=" in current_location(spark, "homed.report")


def test_stream_upserts_every_batch_into_the_table(spark, work, name):
    target = UpsertTable.create(spark, name, buckets=4, location=f"{work}/t")
    assert _state_of(run_batch_job(spark, fx.users(spark), fx.regions(spark), target=target)) == GOLDEN
    feed, seen = _feed(spark, work, [1, 2, 3, 4]), []
    handle = run_stream_job(
        spark, feed.stream(), fx.regions(spark), f"{work}/checkpoint", name, trigger=CONTINUOUS,
        on_stats=lambda batch_id, top: seen.append((batch_id, [r.region_id for r in top.collect()])),
    )
    try:
        _deliver(handle, feed, [1, 2, 3, 4])
    finally:
        handle.stop()
    assert _state_of(target.report(spark)) == fx.EXPECTED_AFTER_BASELINE
    assert [b for b, _ in seen] == [0, 1, 2, 3] and seen[-1][1] == ["R4", "R2", "R1", "R3"]
    assert [r.region_id for r in report_stats(spark, name).collect()] == ["R4", "R2", "R1", "R3"]
    assert _state_of(run_batch_job(spark, fx.users(spark), fx.regions(spark), target=target)) == GOLDEN


def test_a_crash_after_the_upsert_is_replayed_and_counted_once(spark, work, name):
    feed, crashed = _feed(spark, work, [1, 2, 3, 4]), []

    def crash_once(batch_id, top):
        if batch_id == 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("simulated failure after the upsert, before the commit")

    def start():
        return run_stream_job(
            spark, feed.stream(), fx.regions(spark), f"{work}/checkpoint", name, buckets=4, location=f"{work}/t",
            trigger=CONTINUOUS, on_stats=crash_once,
        )

    handle = start()
    try:
        with pytest.raises(Exception):
            _deliver(handle, feed, [1, 2])
    finally:
        handle.stop()
    handle = start()
    try:
        handle.process_all_available()
        _deliver(handle, feed, [3, 4])
    finally:
        handle.stop()
    assert crashed == [1] and _state_of(spark.table(full_name(name))) == fx.EXPECTED_AFTER_EMPTY


def test_dead_letters_replay_into_the_table_once(spark, work, name):
    target = UpsertTable.create(spark, name, buckets=4, location=f"{work}/t")
    run_batch_job(spark, fx.users(spark), fx.regions(spark), target=target)
    feed = _feed(spark, work, [1, 2, 3, 4])

    def refuse(batch, batch_id):
        if batch_id in (0, 2):
            raise ValueError("refused")

    handle = run_stream_job(
        spark, feed.stream(), fx.regions(spark), f"{work}/checkpoint", name, trigger=CONTINUOUS, check=refuse,
        dead_letters=f"{work}/letters", epoch=0,
    )
    try:
        _deliver(handle, feed, [1, 2, 3, 4])
    finally:
        handle.stop()
    assert _state_of(target.report(spark)) != fx.EXPECTED_AFTER_BASELINE
    replay_into_table(spark, f"{work}/letters", fx.regions(spark), target)
    # every REGION is in the baseline, so the order of the batches does not matter
    assert _state_of(target.report(spark)) == fx.EXPECTED_AFTER_BASELINE
    replay_into_table(spark, f"{work}/letters", fx.regions(spark), target)
    assert _state_of(target.report(spark)) == fx.EXPECTED_AFTER_BASELINE
    assert target.position(spark, REPLAY)[0] == 0


def test_stream_to_log_and_fold(spark, work, name):
    baseline = run_batch_job(spark, fx.users(spark), fx.regions(spark), name, location=f"{work}/t")
    feed = _feed(spark, work, [1, 2, 3, 4])
    handle = run_stream_job(
        spark, feed.stream(), fx.regions(spark), f"{work}/checkpoint", log=f"{work}/log", sink="log", trigger=CONTINUOUS
    )
    try:
        _deliver(handle, feed, [1, 2, 3, 4])
    finally:
        handle.stop()
    assert _state_of(logged_report(spark, f"{work}/log", baseline)) == fx.EXPECTED_AFTER_BASELINE


def test_wrong_sinks_are_refused(spark, work):
    for options in ({"sink": "upsert"}, {"sink": "log"}, {"sink": "other", "table": "x"}):
        with pytest.raises(ValueError):
            run_stream_job(spark, None, fx.regions(spark), work, **options)


def test_a_batch_that_resolves_nobody_writes_and_reports_nothing(spark, work, name):
    from regiontally.operators.hierarchy import region_lookup
    from regiontally.operators.report import report_base

    target = UpsertTable.create(spark, name, buckets=4, location=f"{work}/t")
    regions = fx.regions(spark)
    nobody = fx.users(spark, [("n1", "nowhere", None, None, True)])
    for sink in (log_sink(f"{work}/log"), table_sink(target)):
        seen = []

        def seeing(batch_id, n):
            seen.append((batch_id, n))

        batch_callback(region_lookup(regions), report_base(regions), sink, 0, True, seeing)(nobody, 0)
        assert seen == []
        empty = regions.where("1 = 0")
        batch_callback(region_lookup(empty), report_base(empty), sink, 0, True, seeing)(fx.users(spark), 1)
        assert seen == [(1, 0)]
    assert read_log(spark, f"{work}/log").isEmpty() and target.report(spark).isEmpty()


def test_cli_batch_stream_report_replay(spark, capsys, work, name):
    fx.raw_users(spark).write.parquet(f"{work}/users")
    fx.raw_regions(spark).write.parquet(f"{work}/regions")
    first_batch = [(i, None, r, None, a) for b, i, r, a in fx.STREAM_ROWS if b == 1]
    fx.raw_users(spark, first_batch).write.parquet(f"{work}/changes")
    table = ["--table", name, "--location", f"{work}/t", "--buckets", "4"]
    regions = ["--regions", f"{work}/regions"]
    assert cli(["batch", "--users", f"{work}/users", *regions, *table, "--bucketed"]) == 0
    letters = ["--dead-letters", f"{work}/letters"]
    assert cli(["stream", "--users", f"{work}/changes", *regions, *table, "--checkpoint", f"{work}/ckpt", "--available-now", *letters]) == 0
    assert cli(["replay", *regions, *table, *letters]) == 0
    assert cli(["report", *table, "--top", "2"]) == 0
    out = capsys.readouterr().out
    assert "R4" in out and "North" in out and "0 batches replayed" in out
    got = _state_of(UpsertTable.create(spark, name).report(spark))
    assert got["R2"] == (5, 3, 60.0)  # u03 turned inactive: one more dead, total frozen
    assert got["R1"] == (4, 2, 50.0)  # u18 is new: the frozen total does not grow


def test_no_private_folder_off_a_local_master():
    from types import SimpleNamespace

    from regiontally.session import checkpoint_root

    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc))
