"""Column expressions shared by the batch and streaming plans.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
They are written as SQL expression strings (``F.expr``): one parse on the JVM
side instead of one driver round trip per sub-expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anchor kinds of the flattened region lookup: a user points either at a
# district (through ``districtId``) or at a city-or-region (through ``regionId``).
ANCHOR_DISTRICT = "D"
ANCHOR_REGION_OR_CITY = "R"


def anchor_kind_sql(district_id: str = "districtId", region_id: str = "regionId") -> str:
    """Which lookup a user goes through: ``districtId`` wins whenever it is not null.

    A non-null ``districtId`` that does not resolve drops the user; there is no
    fallback to ``regionId``. An empty string is not null.
    """
    return (
        f"CASE WHEN {district_id} IS NOT NULL THEN '{ANCHOR_DISTRICT}' "
        f"WHEN {region_id} IS NOT NULL THEN '{ANCHOR_REGION_OR_CITY}' END"
    )


def anchor_id_sql(district_id: str = "districtId", region_id: str = "regionId") -> str:
    return f"coalesce({district_id}, {region_id})"


def is_dead_sql(active: str = "active") -> str:
    """``active = false``; a NULL ``active`` is not dead (the comparison is NULL)."""
    return f"{active} = false"


def count_dead(user_id: str = "user_doc_id", active: str = "active") -> Column:
    """Conditional count: non-null user ids whose ``active`` is false."""
    return F.expr(f"count(CASE WHEN {is_dead_sql(active)} THEN {user_id} END)")


def mortality_rate_sql(
    dead: str = "dead_population", total: str = "total_population", arithmetic: str = "double"
) -> str:
    """The guarded rate as SQL.

    ``double`` (default): ``100.0D`` is a double literal, as in the batch report.
    ``decimal``: the upsert statement's arithmetic, where ``100.0`` is a
    ``decimal(4,1)`` literal and the quotient a ``decimal(38,14)``, stored as double.
    """
    if arithmetic == "decimal":
        return f"CASE WHEN {total} > 0 THEN CAST({dead} * 100.0 / {total} AS DOUBLE) ELSE 0.0D END"
    if arithmetic != "double":
        raise ValueError(f"unknown arithmetic {arithmetic!r}")
    return f"CASE WHEN {total} > 0 THEN {dead} * 100.0D / {total} ELSE 0.0D END"
