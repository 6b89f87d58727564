"""Batches whose change rows could not be turned into delta rows: kept with their cause, replayed later.

A dead letter is the micro-batch as it came (its source columns), written with
the error to ``<root>/epoch=E/batch_id=N`` in overwrite mode. The stream goes on
with the next batch. :func:`replay` runs the kept batches, in order, through the
same steps into the same table once the cause is mended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.sinks.tables import ensure_dir
from regiontally.streaming.delta_log import batch_path

CAUSE = "dead_letter_cause"


def bury(batch: DataFrame, root: str, epoch: int, batch_id: int, error: Exception) -> None:
    """Keep one failed micro-batch, every row with the cause of the failure."""
    cause = f"{type(error).__name__}: {error}"
    batch.withColumn(CAUSE, F.lit(cause)).write.mode("overwrite").parquet(batch_path(root, epoch, batch_id))


def positions(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """The kept batches in order (one row per failed batch reaches the driver)."""
    ensure_dir(spark, root)
    schema = f"{CAUSE} string, epoch bigint, batch_id bigint"
    kept = spark.read.schema(schema).option("basePath", root).parquet(root).groupBy("epoch", "batch_id").count()
    return sorted((row["epoch"], row["batch_id"]) for row in kept.collect())


def causes(spark: SparkSession, root: str) -> DataFrame:
    """One row per kept batch: ``epoch, batch_id, cause, n_rows``."""
    ensure_dir(spark, root)
    schema = f"{CAUSE} string, epoch bigint, batch_id bigint"
    rows = spark.read.schema(schema).option("basePath", root).parquet(root)
    return rows.groupBy("epoch", "batch_id").agg(F.min(CAUSE).alias("cause"), F.count(F.lit(1)).alias("n_rows"))


def letter(spark: SparkSession, root: str, position: tuple[int, int]) -> DataFrame:
    """The change rows of one kept batch, as they came."""
    return spark.read.parquet(batch_path(root, *position)).drop(CAUSE)


def replay(
    spark: SparkSession,
    root: str,
    apply: Callable[[DataFrame, tuple[int, int]], None],
    after: tuple[int, int] = (-1, -1),
) -> list[tuple[int, int]]:
    """Run ``apply(rows, position)`` for every kept batch after ``after``; returns their positions.

    In order, and stopping with the error at the first batch that fails again, so
    that a fence over positions stays valid.
    """
    due = [p for p in positions(spark, root) if p > after]
    for position in due:
        apply(letter(spark, root, position), position)
    return due
