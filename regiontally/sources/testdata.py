"""Adapter from the driver's TPC-H-ish tables to the user / region collections.

Mapping (all derived from ``region``, ``nation``, ``customer`` and ``events``):

* COUNTRY ``C{r_regionkey}`` per region row; REGION ``R{n_nationkey}`` per
  nation, parent ``C{n_regionkey}``; one empty REGION ``R99`` under ``C0``.
* CITY ``T{nation}-{segment}`` for every (nation, market segment) that has a
  customer; DISTRICT ``D{nation}-{segment}-{custkey % 3}`` likewise. The tree
  is derived from the data with equi-joins and ``distinct``, never a cross join.
* One user per customer, anchored by ``k = c_custkey % 10``: k in 0..3 a
  district, k = 9 a missing district, k in 4, 5 a city, k in 6, 7, 9 a REGION,
  k = 8 only a country. ``active`` is ``c_acctbal >= 0``, NULL when
  ``c_custkey % 50 = 7``.
* Every customer is kept. To exercise duplicate handling, customers with
  ``c_custkey % 20 = 0`` get an exact extra copy and those with
  ``c_custkey % 60 = 4`` a copy with ``active`` negated; these rules add rows,
  they never select a subset.
* Change events: ``events`` joined to the user base on ``user_id``, ``active``
  is ``event_type <> 'error'``, ``batch_id`` is whole days since 2024-01-01.

The three derived relations play the part of the stored collections (users,
regions, user changes): :func:`users`, :func:`regions` and :func:`user_events`
derive each once per application from the whole driver tables, write it as a
parquet table under the shared checkpoint folder, and scan that table, so
every query reads a collection as it would in production (with column pruning
and filter pushdown at the scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regiontally.schemas import (
    CHANGE_SCHEMA,
    CITY,
    COUNTRY,
    DISTRICT,
    REGION,
    REGION_SCHEMA,
    USER_SCHEMA,
)
from regiontally.session import shared_dir
from regiontally.sources.readers import prepare_regions, prepare_users

# Fixed values of the adapter.
EMPTY_REGION_ID = "R99"
EMPTY_REGION_NAME = "NO_MEMBERS"
MISSING_DISTRICT_ID = "D-missing"
STREAM_EPOCH_START = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _key(prefix: str, *parts) -> Column:
    """``prefix`` followed by the parts joined with ``-`` (parts are columns)."""
    pieces: list[Column] = [F.lit(prefix)]
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def conform(df: DataFrame, schema: StructType, *extra: str) -> DataFrame:
    """Project ``df`` onto ``schema`` (missing fields become typed NULLs), then ``extra``."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *extra,
    )


def _customers_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    # nation is a dimension of fixed size (25 rows in TPC-H); Catalyst broadcasts it by statistics.
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner")


def raw_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region tree as raw documents (``_id``, ``name``, ``type``, ``parentRegionId``, ...)."""
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    cn = _customers_with_nation(spark, sf_dir)

    countries = region.select(
        _key("C", F.col("r_regionkey")).alias("_id"),
        F.col("r_name").alias("name"),
        F.lit(COUNTRY).alias("type"),
        F.lit(None).cast("string").alias("parentRegionId"),
    )
    regions = nation.select(
        _key("R", F.col("n_nationkey")).alias("_id"),
        F.col("n_name").alias("name"),
        F.lit(REGION).alias("type"),
        _key("C", F.col("n_regionkey")).alias("parentRegionId"),
    )
    empty_region = region.where(F.col("r_regionkey") == 0).select(
        F.lit(EMPTY_REGION_ID).alias("_id"),
        F.lit(EMPTY_REGION_NAME).alias("name"),
        F.lit(REGION).alias("type"),
        _key("C", F.col("r_regionkey")).alias("parentRegionId"),
    )
    city_keys = cn.select("n_nationkey", "n_name", "c_mktsegment").distinct()
    cities = city_keys.select(
        _key("T", F.col("n_nationkey"), F.col("c_mktsegment")).alias("_id"),
        F.concat_ws("/", "n_name", "c_mktsegment").alias("name"),
        F.lit(CITY).alias("type"),
        _key("R", F.col("n_nationkey")).alias("parentRegionId"),
    )
    district_keys = cn.select(
        "n_nationkey", "n_name", "c_mktsegment", (F.col("c_custkey") % 3).alias("b")
    ).distinct()
    districts = district_keys.select(
        _key("D", F.col("n_nationkey"), F.col("c_mktsegment"), F.col("b")).alias("_id"),
        F.concat_ws("/", "n_name", "c_mktsegment", F.col("b").cast("string")).alias("name"),
        F.lit(DISTRICT).alias("type"),
        _key("T", F.col("n_nationkey"), F.col("c_mktsegment")).alias("parentRegionId"),
    )
    tree = (
        countries.unionByName(regions)
        .unionByName(empty_region)
        .unionByName(cities)
        .unionByName(districts)
    )
    return conform(tree, REGION_SCHEMA)


def _user_columns(cn: DataFrame) -> list[Column]:
    k = F.col("c_custkey") % 10
    district = (
        F.when(k <= 3, _key("D", F.col("c_nationkey"), F.col("c_mktsegment"), F.col("c_custkey") % 3))
        .when(k == 9, F.lit(MISSING_DISTRICT_ID))
    )
    region_id = (
        F.when(k.isin(4, 5), _key("T", F.col("c_nationkey"), F.col("c_mktsegment")))
        .when(k.isin(6, 7, 9), _key("R", F.col("c_nationkey")))
    )
    active = F.when(F.col("c_custkey") % 50 == 7, F.lit(None).cast("boolean")).otherwise(
        F.col("c_acctbal") >= 0
    )
    return [
        F.col("c_custkey"),
        _key("U", F.col("c_custkey")).alias("_id"),
        district.alias("districtId"),
        region_id.alias("regionId"),
        _key("C", F.col("n_regionkey")).alias("countryId"),
        active.alias("active"),
    ]


def user_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user row per customer (plus ``c_custkey`` for joining events)."""
    cn = _customers_with_nation(spark, sf_dir)
    return cn.select(*_user_columns(cn))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User documents: the base plus exact and ``active``-negated copies.

    The copies come from one ``explode`` per row (a narrow operator), so the
    customer table is scanned once rather than once per copy kind.
    """
    base = user_base(spark, sf_dir)
    copy_kinds = F.array_compact(
        F.array(
            F.lit(0),
            F.when(F.col("c_custkey") % 20 == 0, F.lit(1)),
            F.when(F.col("c_custkey") % 60 == 4, F.lit(2)),
        )
    )
    users = base.withColumn("copy_kind", F.explode(copy_kinds)).withColumn(
        "active", F.when(F.col("copy_kind") == 2, ~F.col("active")).otherwise(F.col("active"))
    )
    return conform(users, USER_SCHEMA)


def raw_user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events as full user documents plus ``batch_id`` (days since the stream start)."""
    events = table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    base = user_base(spark, sf_dir)
    joined = events.join(base, events.user_id == base.c_custkey, "inner")
    changed = joined.withColumn("active", F.col("event_type") != "error").withColumn(
        "batch_id",
        F.datediff(F.to_date("ts"), F.lit(STREAM_EPOCH_START).cast("date")).cast("bigint"),
    )
    return conform(changed, USER_SCHEMA, "batch_id")


_TABLES: dict[tuple[str, str, str], str] = {}


def collection_path(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of collection ``name`` derived from ``sf_dir``, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    path = _TABLES.get(key)
    if path is None:
        path = shared_dir(spark, "testdata", name)
        build(spark, sf_dir).write.parquet(path)
        _TABLES[key] = path
    return path


def _collection(spark: SparkSession, sf_dir: str, name: str, build, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(collection_path(spark, sf_dir, name, build))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared users (``user_doc_id`` renamed): a scan of the derived user collection."""
    return prepare_users(_collection(spark, sf_dir, "users", raw_users, USER_SCHEMA))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared regions (renamed key, name, type): a scan of the derived region collection."""
    return prepare_regions(_collection(spark, sf_dir, "regions", raw_regions, REGION_SCHEMA))


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change documents with ``batch_id``: a scan of the derived change collection."""
    return _collection(spark, sf_dir, "user_changes", raw_user_events, CHANGE_SCHEMA)


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared change events with ``batch_id``: a scan of the derived change collection."""
    return prepare_users(raw_changes(spark, sf_dir))
