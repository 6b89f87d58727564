"""Sources by format name with the declared schema, and the key-uniqueness guard."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from regiontally.operators import hierarchy, report
from regiontally.session import shared_dir
from regiontally.sinks.tables import full_name, qualified_name
from regiontally.sources.readers import read_regions, read_users
from tests import fixtures as fx


def test_json_documents_with_nested_fields(spark):
    work = shared_dir(spark, "test-json")
    users = fx.raw_users(spark).withColumn(
        "currentLocation",
        F.struct(
            F.struct(F.lit("Point").alias("type"), F.array(F.lit(1.0), F.lit(2.0)).alias("coordinates")).alias(
                "position"
            ),
            F.lit(2.0).alias("latitude"),
            F.lit(1.0).alias("longitude"),
        ),
    )
    users.write.json(f"{work}/users")
    fx.raw_regions(spark).write.json(f"{work}/regions")
    u = read_users(spark, "json", f"{work}/users")
    r = read_regions(spark, "json", f"{work}/regions")
    assert u.schema["currentLocation"].dataType.fieldNames() == ["position", "latitude", "longitude"]
    got = sorted(
        (x.region_id, x.total_population, x.dead_population) for x in report.mortality_report(u, r).collect()
    )
    assert got == sorted((e[0], e[3], e[4]) for e in fx.EXPECTED_REPORT)


def test_duplicate_region_keys_are_rejected(spark):
    regions = fx.regions(spark)
    duplicated = regions.unionByName(regions.where("region_doc_id = 'T1'"))
    with pytest.raises(ValueError, match="not unique"):
        hierarchy.lookup_size_bound(duplicated)


def test_qualified_names():
    assert qualified_name("analytics.population_report") == (
        "spark_catalog",
        "analytics",
        "population_report",
    )
    assert full_name("report") == "spark_catalog.default.report"
    assert full_name("a.b.c") == "spark_catalog.a.b.c"
