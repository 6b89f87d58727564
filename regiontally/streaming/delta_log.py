"""A log of per-batch delta rows, one folder per batch, written idempotently.

A micro-batch writes its delta rows to ``<root>/epoch=E/batch_id=N`` in overwrite
mode. Spark replays a batch under the same ``batch_id`` after a failure, and the
replay overwrites its own folder, so nothing is counted twice. ``epoch`` names
one checkpoint: Spark restarts ``batch_id`` at 0 for a new checkpoint, so a new
checkpoint takes a larger epoch and the log stays ordered by ``(epoch,
batch_id)``. The log lives in shared storage, like the checkpoint. Read it
between batches: while a batch is replayed its folder is being replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from regiontally.operators.deltas import DELTA_COLUMNS
from regiontally.schemas import DELTA_SCHEMA
from regiontally.sinks.tables import ensure_dir, hadoop_path

LOG_SCHEMA = StructType(
    [
        *DELTA_SCHEMA.fields,
        StructField("epoch", LongType(), True),
        StructField("batch_id", LongType(), True),
    ]
)


def batch_path(root: str, epoch: int, batch_id: int) -> str:
    return f"{root.rstrip('/')}/epoch={int(epoch)}/batch_id={int(batch_id)}"


def checkpoint_epoch(spark: SparkSession, checkpoint_location: str) -> int:
    """The epoch of a started stream: the time (ms) at which its checkpoint was created.

    Spark writes the checkpoint's ``metadata`` file once, when the query first
    starts, and keeps it over restarts; so a restart continues its epoch and a
    later checkpoint has a larger one, without any numbering of our own.
    """
    path, fs = hadoop_path(spark, f"{checkpoint_location.rstrip('/')}/metadata")
    return int(fs.getFileStatus(path).getModificationTime())


def write_batch(delta_rows: DataFrame, root: str, epoch: int, batch_id: int) -> int:
    """Write the log entry of one batch (the delta columns); returns its number of rows.

    One job: the rows are counted by an observation on the write. A batch without
    rows leaves an entry without rows, which also replaces an earlier attempt.
    """
    counted = Observation()
    rows = delta_rows.select(*DELTA_COLUMNS).observe(counted, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").parquet(batch_path(root, epoch, batch_id))
    return int(counted.get["n"])


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The delta rows of every batch with ``epoch`` and ``batch_id``; empty if nothing was logged."""
    ensure_dir(spark, root)
    return spark.read.schema(LOG_SCHEMA).option("basePath", root).parquet(root)
