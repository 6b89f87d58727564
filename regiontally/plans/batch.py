"""Batch plans over prepared ``users`` and ``regions`` relations.

Each function is one named result of the batch job; together they cover the
scans, the level split, the mapped relation (whole and by level), the counts and
the report. Building a plan that resolves users runs one small aggregate over
the region tree (the size bound of its lookup); nothing else is an action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiontally.operators import aggregate, hierarchy, report
from regiontally.operators.hierarchy import MAPPED_COLUMNS

USER_SCAN_COLUMNS = ["user_doc_id", "regionId", "districtId", "countryId", "active"]
REGION_SCAN_COLUMNS = ["region_doc_id", "region_name", "region_type", "parentRegionId"]
PREVIEW_ROWS = 10


def scan_users(users: DataFrame) -> DataFrame:
    return users.select(*USER_SCAN_COLUMNS)


def scan_regions(regions: DataFrame) -> DataFrame:
    return regions.select(*REGION_SCAN_COLUMNS)


def regions_by_level(regions: DataFrame) -> DataFrame:
    return hierarchy.levels(regions)


def users_via(users: DataFrame, regions: DataFrame, level: str) -> DataFrame:
    return hierarchy.users_via(users, regions, level)


def users_mapped(
    users: DataFrame, regions: DataFrame, max_broadcast_bytes: int | None = None, partitions: int | None = None
) -> DataFrame:
    return hierarchy.users_mapped(users, regions, max_broadcast_bytes, partitions)


def users_mapped_by_level(users: DataFrame, regions: DataFrame) -> DataFrame:
    return hierarchy.users_mapped_by_level(users, regions)


def preview_mapped(users: DataFrame, regions: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """A bounded preview of the mapped users (no secret columns), in a total order; a top-k plan."""
    ordered = hierarchy.users_mapped(users, regions).orderBy(*[F.asc_nulls_last(c) for c in MAPPED_COLUMNS])
    return ordered.limit(n)


def total_population(users: DataFrame, regions: DataFrame) -> DataFrame:
    return aggregate.total_population(hierarchy.users_mapped(users, regions))


def dead_population(users: DataFrame, regions: DataFrame) -> DataFrame:
    return aggregate.dead_population(hierarchy.users_mapped(users, regions))


def report_base(regions: DataFrame) -> DataFrame:
    return report.report_base(regions)


def region_parents(regions: DataFrame) -> DataFrame:
    return report.region_parents(regions)


def mortality_report(
    users: DataFrame, regions: DataFrame, ordered: bool = True, max_broadcast_bytes: int | None = None
) -> DataFrame:
    return report.mortality_report(users, regions, ordered=ordered, max_broadcast_bytes=max_broadcast_bytes)


def top20_regions(users: DataFrame, regions: DataFrame) -> DataFrame:
    return report.top_regions(report.mortality_report(users, regions), 20)


def side_table_counts(regions: DataFrame) -> DataFrame:
    """Row counts of the cached side tables of the stream, as Spark aggregates."""
    return (
        regions.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit("regions").alias("relation"), "row_count")
        .unionByName(
            report.region_parents(regions)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit("region_parents").alias("relation"), "row_count")
        )
    )


def is_empty(name: str, df: DataFrame) -> DataFrame:
    """One row ``(relation, is_empty)``; reads at most one row of ``df``."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty")).select(
        F.lit(name).alias("relation"), "is_empty"
    )
