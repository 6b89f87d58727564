"""Population counts per REGION.

``population_counts`` is the single-pass form used by the report and the
stream: ``distinct`` over ``(keys.., user_doc_id, active)`` followed by one
grouped aggregate with a conditional count. Spark plans it as two hash
aggregates, each with a map-side partial step: the first shuffle is keyed by
the user, so no REGION can concentrate it, and copies of one user collapse
before they are shuffled; the second moves one row per REGION per task. The
region name is not carried through the shuffle (it depends on the region id
alone) and is joined back on the small result.

``total_population`` and ``dead_population`` keep the two-aggregate shape of
the inventory (counting over the mapped relation, dead rows filtered first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiontally.functions.expressions import count_dead, is_dead_sql

REGION_KEYS = ["effective_region_id", "effective_region_name"]


def population_counts(
    resolved: DataFrame,
    keys: Sequence[str] = ("effective_region_id",),
    total_name: str = "total_population",
    dead_name: str = "dead_population",
) -> DataFrame:
    """Distinct ``(keys, user, active)`` then ``count(user)`` and ``count(user where dead)``."""
    keys = list(keys)
    return (
        resolved.selectExpr(*keys, "user_doc_id", "active")
        .distinct()
        .groupBy(*keys)
        .agg(F.expr(f"count(user_doc_id) AS {total_name}"), count_dead().alias(dead_name))
    )


def total_population(mapped: DataFrame) -> DataFrame:
    """Mapped users per REGION: ``count(user_doc_id)`` (NULL ids are not counted)."""
    return mapped.groupBy(*REGION_KEYS).agg(F.expr("count(user_doc_id) AS total_population"))


def dead_population(mapped: DataFrame) -> DataFrame:
    """Inactive mapped users per REGION; REGIONs without an inactive row are absent."""
    return (
        mapped.where(is_dead_sql())
        .groupBy(*REGION_KEYS)
        .agg(F.expr("count(user_doc_id) AS dead_population"))
    )
