"""Anchors of the test-table adapter at sf0.001 (FIXTURES.md §4.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiontally.queries import queries
from regiontally.sources import testdata as td
from tests.conftest import SF0001


def _sum(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_user_adapter_counts(spark):
    users = td.users(spark, SF0001)
    assert users.count() == 161
    kinds = users.select(
        F.when(F.col("districtId").isNotNull(), "district")
        .when(F.col("regionId").startswith("T"), "city")
        .when(F.col("regionId").isNotNull(), "region")
        .otherwise("neither")
        .alias("kind")
    ).groupBy("kind").count()
    assert {r.kind: r["count"] for r in kinds.collect()} == {"district": 83, "city": 33, "region": 30, "neither": 15}


def test_report_anchors(spark):
    q = queries()
    report = q["mortality_report"](spark, SF0001)
    assert report.count() == 26
    assert (_sum(report, "total_population"), _sum(report, "dead_population")) == (123, 9)
    assert q["users_mapped"](spark, SF0001).count() == 123
    zero = report.where("total_population = 0").collect()
    assert [r.region_id for r in zero] == ["R99"]


def test_stream_anchors(spark):
    q = queries()
    assert td.user_events(spark, SF0001).count() == 1000
    assert q["batch_deltas"](spark, SF0001).count() == 244
    empty = q["report_after_stream_empty"](spark, SF0001)
    assert (empty.count(), _sum(empty, "total_population"), _sum(empty, "dead_population")) == (9, 16, 133)
    based = q["report_after_stream_with_baseline"](spark, SF0001)
    assert (_sum(based, "total_population"), _sum(based, "dead_population")) == (123, 142)
    assert based.where("mortality_rate_percent > 100").count() == 9
