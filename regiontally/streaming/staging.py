"""Replay a table of change rows as a file stream, one micro-batch per batch value.

Used to replay the driver's ``events`` table as a change stream with exact
batch boundaries. The rows are written once, in parallel, partitioned by their
batch column and rebalanced by adaptive execution (a batch holding a third of
the rows is written by several tasks, small batches do not scatter into many
small files). A batch then *arrives* by an atomic
rename of its folder into the watched directory, the usual landing-directory
pattern for file sources; after each arrival ``processAllAvailable`` makes the
running query take exactly that folder as one micro-batch. Only folder
metadata passes through the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from regiontally.schemas import USER_SCHEMA
from regiontally.sources.readers import stream_users
from regiontally.sinks.tables import ensure_dir, hadoop_path


@dataclass(frozen=True)
class ChangeFeed:
    spark: SparkSession
    root: str
    batch_col: str = "batch_id"

    @property
    def pending(self) -> str:
        return f"{self.root.rstrip('/')}/pending"

    @property
    def incoming(self) -> str:
        return f"{self.root.rstrip('/')}/incoming"

    def stage(self, changes: DataFrame) -> list[int]:
        """Write ``changes`` (documents + batch column) as pending batches; returns them in order.

        The rebalance hint lets adaptive execution size the write tasks by the
        advisory partition size: small batches share a task (few files), and a
        batch holding a large share of the rows is split over several tasks.
        """
        changes.hint("rebalance", self.batch_col).write.mode("append").partitionBy(self.batch_col).parquet(
            self.pending
        )
        return self.pending_batches()

    def pending_batches(self) -> list[int]:
        pattern = re.compile(rf"{re.escape(self.batch_col)}=(-?\d+)$")
        root, fs = hadoop_path(self.spark, self.pending)
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            match = pattern.search(status.getPath().getName())
            if status.isDirectory() and match:
                found.append(int(match.group(1)))
        return sorted(found)

    def release(self, batch: int) -> None:
        """Move one pending batch into the watched directory (one atomic folder rename)."""
        ensure_dir(self.spark, self.incoming)
        src, fs = hadoop_path(self.spark, f"{self.pending}/{self.batch_col}={int(batch)}")
        dst, _ = hadoop_path(self.spark, f"{self.incoming}/batch-{int(batch):09d}")
        if not fs.rename(src, dst):
            raise OSError(f"could not release batch {batch} from {self.pending}")

    def stream(self, fmt: str = "parquet", schema=USER_SCHEMA, options: dict | None = None) -> DataFrame:
        """The watched directory as a streaming DataFrame of prepared user documents."""
        ensure_dir(self.spark, self.incoming)
        return stream_users(self.spark, fmt, f"{self.incoming}/*", options, schema=schema)
