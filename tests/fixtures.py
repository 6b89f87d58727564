"""The edge fixture: a 13-node region tree and 20 user rows hitting every rule.

Expected results are hand-derived from the rules (see FIXTURES.md §3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regiontally.schemas import REGION_SCHEMA, USER_SCHEMA
from regiontally.sources.readers import prepare_regions, prepare_users

# (_id, name, type, parentRegionId)
REGION_ROWS = [
    ("C1", "Country", "COUNTRY", None),
    ("R1", "North", "REGION", "C1"),
    ("R2", "South", "REGION", "C1"),
    ("R3", "Empty", "REGION", "C1"),
    ("R4", None, "REGION", "C1"),
    ("T1", "t1", "CITY", "R1"),
    ("T2", "t2", "CITY", "R2"),
    ("T3", "t3", "CITY", "RX"),
    ("T4", "t4", "CITY", "R4"),
    ("D1", "d1", "DISTRICT", "T1"),
    ("D2", "d2", "DISTRICT", "R1"),
    ("D3", "d3", "DISTRICT", "T3"),
    ("D4", "d4", "DISTRICT", "T2"),
]

# (_id, districtId, regionId, countryId, active)
USER_ROWS = [
    ("u01", "D1", None, "C1", True),
    ("u02", "D1", "R2", "C1", False),
    ("u03", None, "T2", "C1", True),
    ("u04", None, "R2", None, False),
    ("u05", None, "R2", None, None),
    ("u06", "D2", None, None, True),
    ("u07", "D3", None, None, True),
    ("u08", "D9", "R1", None, True),
    ("u09", "", "R1", None, True),
    ("u10", None, None, "C1", True),
    ("u11", None, "D4", None, True),
    ("u12", None, "C1", None, True),
    ("u13", "D4", None, None, False),
    ("u13", "D4", None, None, False),
    ("u14", None, "T1", None, True),
    ("u14", None, "T1", None, False),
    ("u15", None, "T4", None, False),
    (None, None, "R1", None, False),
    ("u16", "T1", None, None, True),
    ("u17", None, "R2", None, True),
]

# (region_id, region_name, parent_country_id, total, dead, rate)
EXPECTED_REPORT = [
    ("R4", None, "C1", 1, 1, 100.0),
    ("R1", "North", "C1", 4, 2, 50.0),
    ("R2", "South", "C1", 5, 2, 40.0),
    ("R3", "Empty", "C1", 0, 0, 0.0),
]
EXPECTED_MAPPED_ROWS = 11

# Change stream over the edge regions: (batch_id, _id, regionId, active)
STREAM_ROWS = [
    (1, "u03", "T2", False),
    (1, "u18", "R1", True),
    (2, "u03", "T2", False),
    (3, "u19", "R3", False),
    (4, "u03", "T2", True),
]

# region_id -> (total, dead, rate) after the stream over the batch report
EXPECTED_AFTER_BASELINE = {
    "R1": (4, 2, 50.0),
    "R2": (5, 4, 80.0),
    "R3": (0, 1, 0.0),
    "R4": (1, 1, 100.0),
}
# ... and over an empty table
EXPECTED_AFTER_EMPTY = {
    "R1": (1, 0, 0.0),
    "R2": (1, 2, 200.0),
    "R3": (1, 1, 100.0),
}


def _doc(schema, values: dict) -> tuple:
    return tuple(values.get(f.name) for f in schema.fields)


def raw_regions(spark: SparkSession) -> DataFrame:
    rows = [
        _doc(REGION_SCHEMA, {"_id": i, "name": n, "type": t, "parentRegionId": p})
        for i, n, t, p in REGION_ROWS
    ]
    return spark.createDataFrame(rows, REGION_SCHEMA)


def raw_users(spark: SparkSession, rows=USER_ROWS) -> DataFrame:
    docs = [
        _doc(USER_SCHEMA, {"_id": i, "districtId": d, "regionId": r, "countryId": c, "active": a})
        for i, d, r, c, a in rows
    ]
    return spark.createDataFrame(docs, USER_SCHEMA)


def regions(spark: SparkSession) -> DataFrame:
    return prepare_regions(raw_regions(spark))


def users(spark: SparkSession, rows=USER_ROWS) -> DataFrame:
    return prepare_users(raw_users(spark, rows))


def stream_users(spark: SparkSession, batch_id: int) -> DataFrame:
    rows = [(i, None, r, None, a) for b, i, r, a in STREAM_ROWS if b == batch_id]
    return users(spark, rows)
