"""Readers for the user and region collections, batch and streaming.

The source format is a parameter (``parquet``, ``json``, ``orc``, or a
connector format such as a document store where its jar is installed). The
schema is always declared, never inferred, so that a document source yields
the same columns whatever the first documents hold, and column pruning can
reach the scan: only the handful of fields a query reads are fetched.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from regiontally.schemas import REGION_SCHEMA, USER_SCHEMA

USER_RENAMES = {"_id": "user_doc_id"}
REGION_RENAMES = {"_id": "region_doc_id", "name": "region_name", "type": "region_type"}


def prepare_users(raw: DataFrame) -> DataFrame:
    """Rename the document key of a raw user relation (``_id`` → ``user_doc_id``)."""
    return raw.withColumnsRenamed(USER_RENAMES)


def prepare_regions(raw: DataFrame) -> DataFrame:
    """Rename the key, name and type of a raw region relation."""
    return raw.withColumnsRenamed(REGION_RENAMES)


def _reader(spark: SparkSession, fmt: str, schema, options: Mapping[str, str] | None):
    reader = spark.read.format(fmt).schema(schema)
    if options:
        reader = reader.options(**options)
    return reader


def read_users(
    spark: SparkSession,
    fmt: str = "parquet",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Batch scan of the user collection with the declared schema, key renamed."""
    reader = _reader(spark, fmt, USER_SCHEMA, options)
    return prepare_users(reader.load(path) if path else reader.load())


def read_regions(
    spark: SparkSession,
    fmt: str = "parquet",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Batch scan of the region collection with the declared schema, three renames."""
    reader = _reader(spark, fmt, REGION_SCHEMA, options)
    return prepare_regions(reader.load(path) if path else reader.load())


def stream_users(
    spark: SparkSession,
    fmt: str = "parquet",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    schema=USER_SCHEMA,
) -> DataFrame:
    """Streaming scan of full user documents (one row per change), key renamed.

    For a change-stream connector pass its options (for example publishing only
    full documents); for files pass ``maxFilesPerTrigger`` to bound a micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if options:
        reader = reader.options(**options)
    return prepare_users(reader.load(path) if path else reader.load())
