"""Golden results on the edge fixture: every resolution and counting rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiontally.operators import aggregate, deltas, hierarchy, report
from regiontally.operators.hierarchy import MAPPED_COLUMNS
from regiontally.plans import incremental
from tests import fixtures as fx


def _key(t):
    return tuple((v is None, v if v is not None else 0) for v in t)


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_report_matches_golden(spark):
    rep = report.mortality_report(fx.users(spark), fx.regions(spark))
    got = sorted(
        (r.region_id, r.region_name, r.parent_country_id, r.total_population, r.dead_population, r.mortality_rate_percent)
        for r in rep.collect()
    )
    assert got == sorted(fx.EXPECTED_REPORT)
    assert {r.region_type for r in rep.collect()} == {"REGION"}


def test_report_order_is_rate_then_total_then_id(spark):
    rep = report.mortality_report(fx.users(spark), fx.regions(spark), ordered=True)
    assert [r.region_id for r in rep.collect()] == ["R4", "R1", "R2", "R3"]


def test_mapped_users_count_and_rules(spark):
    mapped = hierarchy.users_mapped(fx.users(spark), fx.regions(spark))
    rows = mapped.collect()
    assert len(rows) == fx.EXPECTED_MAPPED_ROWS
    by_user = {}
    for r in rows:
        by_user.setdefault(r.user_doc_id, set()).add((r.active, r.effective_region_id))
    assert by_user["u02"] == {(False, "R1")}  # district wins over regionId
    assert by_user["u03"] == {(True, "R2")}  # through a city
    assert by_user["u14"] == {(True, "R1"), (False, "R1")}  # disagreeing copies both stay
    assert by_user["u13"] == {(False, "R2")}  # exact copies collapse
    assert by_user[None] == {(False, "R1")}  # null id maps, but is never counted
    for dropped in ["u06", "u07", "u08", "u09", "u10", "u11", "u12", "u16"]:
        assert dropped not in by_user


def test_branch_form_equals_lookup_form(spark):
    users, regions = fx.users(spark), fx.regions(spark)
    a = _rows(hierarchy.users_mapped(users, regions), MAPPED_COLUMNS)
    b = _rows(hierarchy.users_mapped_by_level(users, regions), MAPPED_COLUMNS)
    assert a == b


def test_two_aggregate_shape_equals_single_pass(spark):
    users, regions = fx.users(spark), fx.regions(spark)
    mapped = hierarchy.users_mapped(users, regions)
    totals = {r.effective_region_id: r.total_population for r in aggregate.total_population(mapped).collect()}
    dead = {r.effective_region_id: r.dead_population for r in aggregate.dead_population(mapped).collect()}
    resolved = hierarchy.resolve_with_regions(users, regions)
    single = {r.effective_region_id: (r.total_population, r.dead_population) for r in aggregate.population_counts(resolved).collect()}
    assert {k: (totals[k], dead.get(k, 0)) for k in totals} == single
    assert dead["R1"] == 2 and totals["R1"] == 4


def test_lookup_kind_tag_blocks_district_named_as_region(spark):
    lookup = hierarchy.region_lookup(fx.regions(spark))
    keys = {(r.anchor_kind, r.anchor_id): r.region_id for r in lookup.collect()}
    assert keys[("D", "D1")] == "R1"
    assert ("R", "D4") not in keys  # regionId naming a district must not resolve
    assert ("D", "D2") not in keys  # district directly under a REGION
    assert ("R", "T3") not in keys  # city under a missing REGION
    assert ("R", "C1") not in keys  # countries are never anchors
    assert keys[("R", "T4")] == "R4"


def _stream_log(spark):
    changes = None
    for b in sorted({row[0] for row in fx.STREAM_ROWS}):
        part = fx.stream_users(spark, b).withColumn("batch_id", F.lit(b).cast("bigint"))
        changes = part if changes is None else changes.unionByName(part)
    return incremental.as_log(incremental.batch_deltas(changes, fx.regions(spark), with_parent=True))


def test_stream_over_baseline(spark):
    baseline = report.mortality_report(fx.users(spark), fx.regions(spark))
    after = deltas.fold(_stream_log(spark), baseline)
    got = {r.region_id: (r.total_population, r.dead_population, r.mortality_rate_percent) for r in after.collect()}
    assert got == fx.EXPECTED_AFTER_BASELINE


def test_stream_over_empty_table(spark):
    after = deltas.fold(_stream_log(spark))
    got = {r.region_id: (r.total_population, r.dead_population, r.mortality_rate_percent) for r in after.collect()}
    assert got == fx.EXPECTED_AFTER_EMPTY
    names = {r.region_id: (r.region_name, r.parent_country_id, r.region_type) for r in after.collect()}
    assert names["R2"] == ("South", "C1", "REGION")


def test_fold_after_skips_covered_batches(spark):
    log = _stream_log(spark)
    baseline = deltas.fold(log.where(F.col("batch_id") <= 2))
    resumed = deltas.fold(log, baseline, after=(0, 2))
    full = deltas.fold(log)
    cols = ["region_id", "total_population", "dead_population", "mortality_rate_percent"]
    assert _rows(resumed, cols) == _rows(full, cols)
