"""The plans Spark runs: strategies, scans, shuffles, and the skew / size guards."""

from __future__ import annotations

from regiontally.operators import hierarchy, report
from regiontally.operators.deltas import deltas
from regiontally.operators.hierarchy import MAPPED_COLUMNS
from regiontally.operators.joins import hot_keys, measure, salted_join
from regiontally.plans.inspect import operator_counts, physical_plan, scans_of
from regiontally.sources import testdata as td
from tests import fixtures as fx
from tests.conftest import SF001


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((v is None, v or 0) for v in t))


def test_report_plan_shape(spark):
    users, regions = td.users(spark, SF001), td.regions(spark, SF001)
    df = report.mortality_report(users, regions, ordered=True)
    df.collect()
    counts = operator_counts(df)
    assert counts["broadcast_joins"] >= 1
    assert counts["sort_merge_joins"] == 0
    assert counts["range_shuffles"] == 1  # the sort is distributed
    assert counts["file_scans"] <= 5  # users, the tree with its parents and grandparents, the REGIONs
    user_scans = scans_of(df, "testdata/users")
    assert len(user_scans) == 1  # users are read once
    scan = user_scans[0]
    for needed in ("_id", "regionId", "districtId", "active"):
        assert needed in scan
    for pruned in ("password", "currentLocation", "username", "socialRating"):
        assert pruned not in scan


def test_distinct_shuffle_is_keyed_by_user(spark):
    users, regions = td.users(spark, SF001), td.regions(spark, SF001)
    df = report.mortality_report(users, regions)
    df.collect()
    plan = physical_plan(df)
    keyed = [line for line in plan.splitlines() if "hashpartitioning(" in line and "user_doc_id" in line]
    assert keyed, plan  # copies and hot REGIONs cannot concentrate this shuffle
    assert any("partial_count" in line for line in plan.splitlines())


def test_levels_read_users_once_each(spark):
    users, regions = td.users(spark, SF001), td.regions(spark, SF001)
    for level in hierarchy.LEVELS:
        df = hierarchy.users_via(users, regions, level)
        df.collect()
        (scan,) = scans_of(df, "testdata/users")
        assert "Or(IsNotNull(districtId),IsNotNull(regionId))" in scan


def test_region_scan_keeps_its_tasks(spark):
    """Neither the report nor its sort pulls the scan of the tree into one task."""
    plan = physical_plan(report.mortality_report(td.users(spark, SF001), td.regions(spark, SF001), ordered=True))
    assert "Coalesce" not in plan


def test_a_region_that_vanishes_between_reads_keeps_its_delta(spark):
    resolved = hierarchy.resolve_with_regions(fx.users(spark), fx.regions(spark))
    base = report.report_base(fx.regions(spark)).where("region_id <> 'R1'")
    got = {r.effective_region_id: r for r in deltas(resolved, base).collect()}
    assert got["R1"].total_population_change > 0 and got["R1"].effective_region_name is None


def test_lookup_bound_is_an_upper_bound(spark):
    for regions in (fx.regions(spark), td.regions(spark, SF001)):
        bound = hierarchy.lookup_size_bound(regions)
        actual = measure(hierarchy.region_lookup(regions))
        assert actual.rows <= bound.rows
        assert actual.bytes <= bound.bytes


def _hot_users(spark):
    hot = [(f"h{i}", "D1", None, None, i % 3 == 0) for i in range(300)]
    return fx.users(spark, hot + fx.USER_ROWS)


def test_salted_fallback_equals_broadcast(spark):
    users, regions = _hot_users(spark), fx.regions(spark)
    broadcast = hierarchy.users_mapped(users, regions)
    for partitions in (None, 4, 64):
        salted = hierarchy.users_mapped(users, regions, max_broadcast_bytes=0, partitions=partitions)
        assert _rows(salted, MAPPED_COLUMNS) == _rows(broadcast, MAPPED_COLUMNS)
        assert len(_rows(salted, MAPPED_COLUMNS)) == fx.EXPECTED_MAPPED_ROWS + 300


def test_salted_join_reads_users_once_and_spreads_the_hot_key(spark):
    from pyspark.sql import functions as F

    users, regions = td.users(spark, SF001), td.regions(spark, SF001)
    one_anchor = users.withColumn("districtId", F.lit("D0-BUILDING-0")).withColumn("regionId", F.lit(None).cast("string"))
    everyone = one_anchor.unionByName(users)  # more than half of all rows at one district
    anchored, lookup = hierarchy.anchored_users(everyone), hierarchy.region_lookup(regions)
    joined = salted_join(anchored, lookup, hierarchy.LOOKUP_KEYS, partitions=16)
    joined.collect()
    assert len(scans_of(joined, "testdata/users")) == 2  # one per branch of the union above
    assert not any("LeftAnti" in line or "LeftSemi" in line for line in physical_plan(joined).splitlines())
    (hot,) = hot_keys(anchored, hierarchy.LOOKUP_KEYS, 4).where("anchor_id = 'D0-BUILDING-0'").collect()
    assert hot["_salts"] >= 3
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the partitions visible
    try:
        again = salted_join(anchored, lookup, hierarchy.LOOKUP_KEYS, partitions=16)
        sizes = [r["count"] for r in again.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", previous)
    assert max(sizes) < 4 * sum(sizes) / 16  # a few salts may hash together; the key alone is half of all rows


def test_registered_hot_anchor_plan_reads_users_once(spark):
    from regiontally.queries import queries

    df = queries()["users_mapped_hot_anchors"](spark, SF001)
    df.collect()
    (scan,) = scans_of(df, "testdata/users")
    assert "password" not in scan


def test_copies_of_one_user_are_kept_by_the_salted_join(spark):
    users = fx.users(spark, [("same", "D1", None, None, True)] * 500 + fx.USER_ROWS).repartition(8)
    joined = salted_join(
        hierarchy.anchored_users(users), hierarchy.region_lookup(fx.regions(spark)), hierarchy.LOOKUP_KEYS, partitions=8
    )
    assert joined.where("user_doc_id = 'same'").count() == 500


def test_report_with_fallback_join_matches(spark):
    users, regions = td.users(spark, SF001), td.regions(spark, SF001)
    cols = ["region_id", "total_population", "dead_population", "mortality_rate_percent"]
    a = report.mortality_report(users, regions)
    b = report.mortality_report(users, regions, max_broadcast_bytes=0)
    assert _rows(a, cols) == _rows(b, cols)


def test_anchor_predicate_reaches_the_users_scan(spark):
    users, regions = td.users(spark, SF001), td.regions(spark, SF001)
    df = hierarchy.users_mapped(users, regions)
    df.collect()
    scan = scans_of(df, "testdata/users")[0]
    assert "Or(IsNotNull(districtId),IsNotNull(regionId))" in scan


def test_hot_keys_are_bounded_and_nulls_dropped(spark):
    rows = [(f"h{i}", "D1", None, None, True) for i in range(400)]  # one anchor holds most rows
    rows += [(f"n{i}", None, None, None, True) for i in range(50)]  # NULL anchor: never joins
    rows += fx.USER_ROWS
    users, regions = fx.users(spark, rows), fx.regions(spark)
    anchored = hierarchy.anchored_users(users)
    hot = hot_keys(anchored, hierarchy.LOOKUP_KEYS, partitions=4).collect()
    assert [(r.anchor_kind, r.anchor_id) for r in hot] == [("D", "D1")]
    joined = salted_join(anchored, hierarchy.region_lookup(regions), hierarchy.LOOKUP_KEYS, partitions=4)
    assert joined.where("user_doc_id LIKE 'n%'").count() == 0
    assert joined.where("anchor_id = 'D1'").count() == 402


def test_hot_region_is_spread_over_the_distinct_shuffle(spark):
    from pyspark.sql import functions as F

    from regiontally.operators.aggregate import population_counts

    hot = [(f"h{i}", None, "R1", None, i % 2 == 0) for i in range(3600)]  # 90 % in one REGION
    cold = [(f"c{i}", None, "R2", None, True) for i in range(400)]
    users, regions = fx.users(spark, hot + cold), fx.regions(spark)
    resolved = hierarchy.resolve_with_regions(users, regions)
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the 8 hash partitions visible
    try:
        distinct = resolved.select("effective_region_id", "user_doc_id", "active").distinct()
        sizes = [r["count"] for r in distinct.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        counts = {r.effective_region_id: r.total_population for r in population_counts(resolved).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", previous)
    assert sum(sizes) == 4000 and len(sizes) == 8
    assert max(sizes) < 0.25 * 4000  # the hot REGION does not land on one reducer
    assert counts == {"R1": 3600, "R2": 400}
