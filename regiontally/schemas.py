"""Declared schemas of the inputs and outputs.

Every field is nullable, as in the source collections. Nested fields are
declared so that a document source can be read with a fixed schema, but no
query touches them: Catalyst prunes them from the scan.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _nullable(name: str, dtype) -> StructField:
    return StructField(name, dtype, True)


GEO_POINT = StructType(
    [_nullable("type", StringType()), _nullable("coordinates", ArrayType(DoubleType()))]
)

GEO_POLYGON = StructType(
    [
        _nullable("type", StringType()),
        _nullable("coordinates", ArrayType(ArrayType(ArrayType(DoubleType())))),
    ]
)

USER_SCHEMA = StructType(
    [
        _nullable("_id", StringType()),
        _nullable("id", StringType()),
        _nullable("username", StringType()),
        _nullable("password", StringType()),
        _nullable("fullName", StringType()),
        _nullable("socialRating", DoubleType()),
        _nullable("status", StringType()),
        _nullable(
            "currentLocation",
            StructType(
                [
                    _nullable("position", GEO_POINT),
                    _nullable("latitude", DoubleType()),
                    _nullable("longitude", DoubleType()),
                ]
            ),
        ),
        _nullable("regionId", StringType()),
        _nullable("districtId", StringType()),
        _nullable("countryId", StringType()),
        _nullable("active", BooleanType()),
        _nullable("lastLocationUpdateTimestamp", LongType()),
    ]
)

REGION_SCHEMA = StructType(
    [
        _nullable("_id", StringType()),
        _nullable("id", StringType()),
        _nullable("name", StringType()),
        _nullable("type", StringType()),
        _nullable("parentRegionId", StringType()),
        _nullable("boundaries", GEO_POLYGON),
        _nullable("averageSocialRating", DoubleType()),
        _nullable("populationCount", LongType()),
        _nullable("importantPersonsCount", LongType()),
        _nullable("underThreat", BooleanType()),
    ]
)

# A user document in a bounded change table: the micro-batch it belongs to is a column.
CHANGE_SCHEMA = StructType([*USER_SCHEMA.fields, _nullable("batch_id", LongType())])

REPORT_SCHEMA = StructType(
    [
        _nullable("region_id", StringType()),
        _nullable("region_name", StringType()),
        _nullable("region_type", StringType()),
        _nullable("parent_country_id", StringType()),
        _nullable("total_population", LongType()),
        _nullable("dead_population", LongType()),
        _nullable("mortality_rate_percent", DoubleType()),
    ]
)

REPORT_COLUMNS = [f.name for f in REPORT_SCHEMA.fields]

REPORT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in REPORT_SCHEMA.fields)

# One row per REGION touched by one micro-batch; (epoch, batch_id) orders the log.
DELTA_SCHEMA = StructType(
    [
        _nullable("effective_region_id", StringType()),
        _nullable("effective_region_name", StringType()),
        _nullable("total_population_change", LongType()),
        _nullable("dead_population_change", LongType()),
        _nullable("parent_country_id_source", StringType()),
    ]
)

# Fixed values of the region tree: the node types a query distinguishes.
COUNTRY = "COUNTRY"
REGION = "REGION"
CITY = "CITY"
DISTRICT = "DISTRICT"
