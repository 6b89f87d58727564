"""Report tables in a catalog: namespace, full refresh, create-if-absent, upsert.

The table provider is a parameter. With a catalog that supports replace and
row-level operations (a v2 table format), ``replace_report`` uses
``writeTo(...).createOrReplace()`` and ``merge_deltas`` the ``MERGE INTO``
statement. The built-in session catalog with file tables supports neither:
there ``replace_report`` writes the report to a new folder and switches the
table's location to it, and :mod:`regiontally.sinks.upsert` rewrites the touched
buckets of a bucketed table.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from regiontally.functions.expressions import mortality_rate_sql
from regiontally.schemas import REGION, REPORT_COLUMNS, REPORT_DDL

DEFAULT_CATALOG = "spark_catalog"
DEFAULT_NAMESPACE = "default"
#: Error conditions of a catalog that has no CREATE OR REPLACE.
NO_REPLACE = ("UNSUPPORTED_FEATURE", "NOT_SUPPORTED_COMMAND_FOR_V2_TABLE", "_LEGACY_ERROR_TEMP", "MISSING_CATALOG_ABILITY")


def qualified_name(table: str, catalog: str = DEFAULT_CATALOG) -> tuple[str, str, str]:
    """``(catalog, namespace, table)``; what stands before the first dot is the namespace, if there is one."""
    head, dot, tail = table.partition(".")
    return (catalog, head, tail) if dot else (catalog, DEFAULT_NAMESPACE, head)


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def ensure_dir(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.mkdirs(p)


def full_name(table: str, catalog: str = DEFAULT_CATALOG) -> str:
    return ".".join(qualified_name(table, catalog))


def ensure_namespace(spark: SparkSession, table: str, catalog: str = DEFAULT_CATALOG, location: str | None = None) -> None:
    cat, ns, _ = qualified_name(table, catalog)
    clause = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {cat}.{ns}{clause}")


def replace_report(
    report: DataFrame,
    table: str,
    catalog: str = DEFAULT_CATALOG,
    provider: str = "parquet",
    location: str | None = None,
) -> str:
    """Create or replace ``table`` with ``report`` (a full refresh); returns the full name.

    Where the catalog cannot replace a table, by :func:`switch_version`.
    """
    spark = report.sparkSession
    ensure_namespace(spark, table, catalog)
    name = full_name(table, catalog)
    rows = report.select(*REPORT_COLUMNS)
    try:
        writer = rows.writeTo(name).using(provider)
        if location:
            writer = writer.tableProperty("location", location)
        writer.createOrReplace()
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith(NO_REPLACE):
            raise
        switch_version(rows, table, catalog, provider, location)
    return name


def _versions_root(spark: SparkSession, table: str, catalog: str, location: str | None) -> str:
    if location:
        return location.rstrip("/")
    cat, ns, name = qualified_name(table, catalog)
    described = spark.sql(f"DESCRIBE NAMESPACE {cat}.{ns}").collect()
    (folder,) = [row["info_value"] for row in described if row["info_name"] == "Location"]
    return f"{folder.rstrip('/')}/{name}"


def switch_version(
    rows: DataFrame,
    table: str,
    catalog: str = DEFAULT_CATALOG,
    provider: str = "parquet",
    location: str | None = None,
) -> str:
    """Write ``rows`` to a new folder, then point the table at it; returns the folder.

    Folders are ``<location>/version=<id>`` (``location`` defaults to the table's
    folder in its namespace). The table keeps its old rows until the new folder is
    complete, so a write that fails changes nothing, and the switch itself is one
    change of the catalog entry. Readers that have planned before it go on reading
    the old folder, which stays until :func:`drop_old_versions`.
    """
    spark = rows.sparkSession
    name = full_name(table, catalog)
    version = f"{_versions_root(spark, table, catalog, location)}/version={uuid.uuid4().hex}"
    rows.write.format(provider).save(version)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    else:
        spark.sql(f"CREATE TABLE {name} ({REPORT_DDL}) USING {provider} LOCATION '{version}'")
    spark.catalog.refreshTable(name)
    return version


def current_location(spark: SparkSession, table: str, catalog: str = DEFAULT_CATALOG) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name(table, catalog)}").collect()
    return [row["data_type"] for row in described if row["col_name"] == "Location"][-1]


def drop_old_versions(spark: SparkSession, table: str, catalog: str = DEFAULT_CATALOG, keep: int = 1) -> list[str]:
    """Delete the version folders of ``table`` but its current one and the ``keep`` newest others.

    For when no reader of an older version is left and no replace is running.
    """
    current, fs = hadoop_path(spark, current_location(spark, table, catalog))
    siblings = [s for s in fs.listStatus(current.getParent()) if s.getPath().getName().startswith("version=")]
    others = [s for s in siblings if s.getPath().getName() != current.getName()]
    others.sort(key=lambda s: s.getModificationTime(), reverse=True)
    dropped = [s.getPath() for s in others[keep:]]
    for path in dropped:
        fs.delete(path, True)
    return [path.toString() for path in dropped]


def create_report_if_absent(
    spark: SparkSession,
    table: str,
    catalog: str = DEFAULT_CATALOG,
    provider: str = "parquet",
    location: str | None = None,
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with the fixed seven-column schema; returns the full name."""
    ensure_namespace(spark, table, catalog)
    name = full_name(table, catalog)
    clause = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({REPORT_DDL}) USING {provider}{clause}")
    return name


#: Report column -> its value in an inserted row, in terms of a delta row ``d``.
INSERTED = {
    "region_id": "d.effective_region_id",
    "region_name": "d.effective_region_name",
    "region_type": f"'{REGION}'",
    "parent_country_id": "d.parent_country_id_source",
    "total_population": "d.total_population_change",
    "dead_population": "d.dead_population_change",
}


def merge_sql(table: str, deltas: str, rate_arithmetic: str = "double") -> str:
    """The upsert of one batch of delta rows, generated from the report's columns."""
    dead = f"(r.dead_population + {INSERTED['dead_population']})"
    values = INSERTED | {
        "mortality_rate_percent": mortality_rate_sql(INSERTED["dead_population"], INSERTED["total_population"], rate_arithmetic)
    }
    changed = {"dead_population": dead, "mortality_rate_percent": mortality_rate_sql(dead, "r.total_population", rate_arithmetic)}
    return (
        f"MERGE INTO {table} AS r USING {deltas} AS d ON r.region_id = {values['region_id']} "
        f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = {v}' for c, v in changed.items())} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(REPORT_COLUMNS)}) VALUES ({', '.join(values[c] for c in REPORT_COLUMNS)})"
    )


def merge_deltas(
    delta_rows: DataFrame, table: str, catalog: str = DEFAULT_CATALOG, view: str = "batch_deltas", rate_arithmetic: str = "decimal"
) -> None:
    """Upsert one batch of delta rows with ``MERGE INTO`` (needs a row-level-capable table).

    Same semantics as :func:`regiontally.operators.deltas.fold`; the rate is
    computed in decimals and stored as double unless ``rate_arithmetic`` says
    ``"double"``. Not idempotent: a replayed batch would add twice, unlike
    :meth:`regiontally.sinks.upsert.UpsertTable.upsert`.
    """
    delta_rows.createOrReplaceTempView(view)
    delta_rows.sparkSession.sql(merge_sql(full_name(table, catalog), view, rate_arithmetic))
