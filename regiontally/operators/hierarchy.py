"""Resolve users to their REGION through the COUNTRY → REGION → CITY → DISTRICT tree.

The tree is flattened once into ``(anchor_kind, anchor_id) → region``
(``region_lookup``: every node with its parent and grandparent, two self-joins)
and every user goes through a single equi-join (``resolve_users``). Users are
scanned once; the lookup is broadcast only when an upper bound computed from
the region table proves it small, and otherwise joined by a salted shuffle
join. ``users_via`` restricts the lookup to one level of the anchor, so the
results per level come from the same join.

Rules: a non-null ``districtId`` decides alone (no fallback to ``regionId``);
the district chain must be exactly DISTRICT → CITY → REGION; ``regionId`` may
name a CITY (one hop) or a REGION (no hop), never a DISTRICT or COUNTRY; all
joins use the document key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiontally.functions.expressions import (
    ANCHOR_DISTRICT,
    ANCHOR_REGION_OR_CITY,
    anchor_id_sql,
    anchor_kind_sql,
)
from regiontally.operators.joins import ROW_OVERHEAD_BYTES, RelationSize, broadcast_limit, dimension_join
from regiontally.schemas import CITY, DISTRICT, REGION

MAPPED_COLUMNS = ["user_doc_id", "active", "effective_region_id", "effective_region_name"]
LOOKUP_KEYS = ["anchor_kind", "anchor_id"]
LEVELS = (REGION, CITY, DISTRICT)


def regions_by_level(regions: DataFrame, level: str) -> DataFrame:
    """Nodes of one level (exact, case-sensitive type match; a NULL type matches nothing)."""
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}")
    return regions.where(f"region_type = '{level}'")


def levels(regions: DataFrame) -> DataFrame:
    """REGION, CITY and DISTRICT nodes with their type (COUNTRY and unknown types excluded)."""
    return regions.where(f"region_type IN ('{REGION}', '{CITY}', '{DISTRICT}')").selectExpr(
        "region_type", "region_doc_id", "region_name", "parentRegionId"
    )


def region_lookup(regions: DataFrame) -> DataFrame:
    """Flatten the tree to ``(anchor_kind, anchor_id) → region_id, region_name, parent_country_id``.

    One pass up the tree: each node with its parent and grandparent, of which the
    node's own level picks the REGION (a REGION itself, a CITY's parent, the
    grandparent of a DISTRICT under a CITY). ``anchor_level`` is the node's level;
    a DISTRICT is an anchor of kind ``'D'``, a CITY or REGION of kind ``'R'``.
    Unique on the key when document keys are unique. Its size grows with the
    tree, not with the users.
    """
    nodes = levels(regions)
    up = nodes.where(f"region_type IN ('{REGION}', '{CITY}')").selectExpr(
        "region_doc_id AS up_id", "struct(region_doc_id, region_type, region_name, parentRegionId) AS up"
    )
    top = regions_by_level(regions, REGION).selectExpr(
        "region_doc_id AS top_id", "struct(region_doc_id, region_type, region_name, parentRegionId) AS top"
    )
    chain = nodes.join(up, F.expr("parentRegionId = up_id"), "left").join(top, F.expr("up.parentRegionId = top_id"), "left")
    own = "struct(region_doc_id, region_type, region_name, parentRegionId)"
    found = chain.selectExpr(
        "region_type AS anchor_level",
        "region_doc_id AS anchor_id",
        f"CASE WHEN region_type = '{REGION}' THEN {own} "
        f"WHEN region_type = '{CITY}' AND up.region_type = '{REGION}' THEN up "
        f"WHEN region_type = '{DISTRICT}' AND up.region_type = '{CITY}' THEN top END AS region",
    )
    return found.where("region IS NOT NULL").selectExpr(
        f"CASE WHEN anchor_level = '{DISTRICT}' THEN '{ANCHOR_DISTRICT}' ELSE '{ANCHOR_REGION_OR_CITY}' END AS anchor_kind",
        "anchor_id",
        "anchor_level",
        "region.region_doc_id AS region_id",
        "region.region_name AS region_name",
        "region.parentRegionId AS parent_country_id",
    )


def lookup_size_bound(regions: DataFrame) -> RelationSize:
    """Upper bound on the size of :func:`region_lookup`, from one aggregate over ``regions``.

    Every REGION, CITY and DISTRICT node yields at most one lookup row, whose
    strings are at most two node ids plus the name and parent of a REGION. That
    holds because the document keys of these nodes are unique, which the same
    aggregate verifies (a duplicated key would make the joins fan out): it raises
    if they are not. Every path that resolves users takes this bound first, which
    runs one aggregate over the tree while the plan is built.
    """
    node = f"region_type IN ('{REGION}', '{CITY}', '{DISTRICT}')"
    region = f"region_type = '{REGION}'"
    row = regions.agg(
        F.expr(f"count(CASE WHEN {node} THEN 1 END) AS rows"),
        F.expr(f"count(CASE WHEN {node} THEN region_doc_id END) AS ids"),
        F.expr(f"count(DISTINCT CASE WHEN {node} THEN region_doc_id END) AS distinct_ids"),
        F.expr(f"coalesce(max(CASE WHEN {node} THEN octet_length(region_doc_id) END), 0) AS id_len"),
        F.expr(f"coalesce(max(CASE WHEN {region} THEN octet_length(region_name) END), 0) AS name_len"),
        F.expr(f"coalesce(max(CASE WHEN {region} THEN octet_length(parentRegionId) END), 0) AS parent_len"),
    ).first()
    if row["ids"] != row["distinct_ids"]:
        raise ValueError(
            f"region document keys are not unique: {row['ids'] - row['distinct_ids']} duplicated ids"
        )
    width = 1 + 2 * row["id_len"] + row["name_len"] + row["parent_len"] + ROW_OVERHEAD_BYTES
    return RelationSize(int(row["rows"]), int(row["rows"]) * int(width))


def lookup_broadcastable(regions: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the lookup of ``regions`` is proven small enough to broadcast."""
    return lookup_size_bound(regions).bytes <= broadcast_limit(regions, max_bytes)


def anchored_users(users: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Project users to the columns resolution needs (plus ``carry``), with their lookup key.

    Users with neither id can never resolve; filtering them with a plain
    predicate lets the scan push it down (``Or(IsNotNull, IsNotNull)``).
    """
    return users.where("districtId IS NOT NULL OR regionId IS NOT NULL").selectExpr(
        *carry,
        "user_doc_id",
        "active",
        f"{anchor_kind_sql()} AS anchor_kind",
        f"{anchor_id_sql()} AS anchor_id",
    )


def resolve_users(
    users: DataFrame,
    lookup: DataFrame,
    max_broadcast_bytes: int | None = None,
    carry: Sequence[str] = (),
    broadcast: bool | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Every user row that resolves, with its REGION (bag: copies are kept).

    Output: ``carry.., user_doc_id, active, effective_region_id,
    effective_region_name, parent_country_id``. Users with neither a district
    nor a region id carry a NULL key and are dropped by the inner join.
    """
    joined = dimension_join(
        anchored_users(users, carry), lookup, LOOKUP_KEYS, max_broadcast_bytes, broadcast, partitions
    )
    return joined.selectExpr(
        *carry,
        "user_doc_id",
        "active",
        "region_id AS effective_region_id",
        "region_name AS effective_region_name",
        "parent_country_id",
    )


def resolve_with_regions(
    users: DataFrame,
    regions: DataFrame,
    max_broadcast_bytes: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """:func:`resolve_users` through the lookup of ``regions``, the broadcast decided on its bound."""
    return resolve_users(
        users,
        region_lookup(regions),
        carry=carry,
        broadcast=lookup_broadcastable(regions, max_broadcast_bytes),
    )


def users_mapped(
    users: DataFrame, regions: DataFrame, max_broadcast_bytes: int | None = None, partitions: int | None = None
) -> DataFrame:
    """Distinct ``(user_doc_id, active, effective_region_id, effective_region_name)``.

    Identical copies collapse; copies that disagree on ``active`` both stay.
    The name depends on the region id alone, so when the tree is proven small
    the distinct shuffles ids only and the names are attached afterwards by a
    broadcast join (map-side); otherwise the name rides the shuffle, of which
    ``partitions`` sets the size (and with it what counts as a hot anchor).
    """
    small_tree = lookup_broadcastable(regions, max_broadcast_bytes)
    resolved = resolve_users(users, region_lookup(regions), broadcast=small_tree, partitions=partitions)
    if not small_tree:
        return resolved.select(*MAPPED_COLUMNS).distinct()
    names = regions_by_level(regions, REGION).selectExpr(
        "region_doc_id AS effective_region_id", "region_name AS effective_region_name"
    )
    ids = resolved.selectExpr("user_doc_id", "active", "effective_region_id").distinct()
    return ids.join(F.broadcast(names), "effective_region_id", "inner").selectExpr(*MAPPED_COLUMNS)


def users_via(users: DataFrame, regions: DataFrame, level: str, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Users whose anchor is a node of ``level`` (bag: copies are kept), in the mapped columns."""
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}")
    small_tree = lookup_broadcastable(regions, max_broadcast_bytes)
    lookup = region_lookup(regions).where(f"anchor_level = '{level}'")
    return resolve_users(users, lookup, broadcast=small_tree).select(*MAPPED_COLUMNS)


def users_mapped_by_level(users: DataFrame, regions: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """:func:`users_mapped` put together from the levels, which hold disjoint sets of anchors."""
    parts = [users_via(users, regions, level, max_broadcast_bytes) for level in LEVELS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()
