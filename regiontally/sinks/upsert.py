"""The report as a table that every batch of delta rows is upserted into, by Spark alone.

For catalogs without row-level operations. The table is partitioned by a hash of
``region_id`` (``bucket``); an upsert is copy-on-write: it reads the buckets that
the batch touches, joins them with the delta rows and writes these buckets back
by dynamic partition overwrite. Untouched buckets are neither read nor written.

Replays change nothing: every row carries a fence, the position of the last
batch that was applied to it, and a batch at or before a row's fence leaves the
row as it is. So a batch can be applied any number of times, also when an
earlier attempt had replaced only some of its buckets. Batches of one lane must
arrive in order; there are two lanes with a fence of their own, ``stream`` and
``replay`` (dead letters, which come late by nature).

The commit moves each rewritten bucket into place by itself: readers may see
some buckets before others, and a driver that dies inside the move of one bucket
loses that bucket's folder. Where that matters, use a table format and
``tables.merge_deltas``. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regiontally.functions.expressions import mortality_rate_sql
from regiontally.operators.deltas import DELTA_COLUMNS
from regiontally.schemas import REGION, REPORT_COLUMNS, REPORT_DDL
from regiontally.sinks.tables import DEFAULT_CATALOG, ensure_dir, ensure_namespace, full_name

STREAM, REPLAY = "stream", "replay"
#: Lane -> the columns of its fence.
FENCES = {STREAM: ("epoch", "batch_id"), REPLAY: ("replay_epoch", "replay_batch_id")}
FENCE_COLUMNS = [c for pair in FENCES.values() for c in pair]
BUCKETS_PROPERTY = "regiontally.buckets"
DEFAULT_BUCKETS = 64
BEFORE_ALL = (-1, -1)


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    previous = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, previous)


@dataclass(frozen=True)
class UpsertTable:
    """A bucketed report table in a catalog; ``buckets`` is fixed when it is created."""

    name: str
    buckets: int
    rate_arithmetic: str = "double"

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        table: str,
        buckets: int = DEFAULT_BUCKETS,
        catalog: str = DEFAULT_CATALOG,
        provider: str = "parquet",
        location: str | None = None,
        rate_arithmetic: str = "double",
    ) -> UpsertTable:
        """Create the table if it is absent (its seven report columns first), else open it.

        With a ``location`` that holds data the partitions found there are taken in.
        """
        ensure_namespace(spark, table, catalog)
        name = full_name(table, catalog)
        fences = ", ".join(f"{c} BIGINT" for c in FENCE_COLUMNS)
        clause = f" LOCATION '{location}'" if location else ""
        fresh = not spark.catalog.tableExists(name)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({REPORT_DDL}, {fences}, bucket INT) USING {provider} "
            f"PARTITIONED BY (bucket){clause} TBLPROPERTIES ('{BUCKETS_PROPERTY}'='{int(buckets)}')"
        )
        if fresh and location:
            ensure_dir(spark, location)
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        stored = spark.sql(f"SHOW TBLPROPERTIES {name} ('{BUCKETS_PROPERTY}')").first()["value"]
        return cls(name, int(stored), rate_arithmetic)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The table as it is now: another session (a stream has its own) may have rewritten buckets."""
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def report(self, spark: SparkSession) -> DataFrame:
        """The seven report columns."""
        return self.rows(spark).select(*REPORT_COLUMNS)

    def position(self, spark: SparkSession, lane: str = STREAM) -> tuple[int, int]:
        """The newest batch of ``lane`` that changed a row (``(-1, -1)`` if none did)."""
        epoch, batch = FENCES[lane]
        newest = self.rows(spark).agg(F.expr(f"max(struct({epoch} AS e, {batch} AS b)) AS p")).first()["p"]
        return (newest["e"], newest["b"]) if newest is not None else BEFORE_ALL

    def _bucket(self, key: str) -> Column:
        return F.expr(f"CAST(pmod(xxhash64({key}), {self.buckets}) AS INT)").alias("bucket")

    def _write(self, rows: DataFrame) -> None:
        spark = rows.sparkSession
        ordered = rows.select(*REPORT_COLUMNS, *FENCE_COLUMNS, "bucket")
        with _dynamic_overwrite(spark):
            # one file a bucket: every bucket's rows come together in one task
            ordered.repartition("bucket").write.mode("overwrite").insertInto(self.name)

    def refresh(self, report: DataFrame, position: tuple[int, int] | None = None) -> None:
        """Replace all rows by a full report that contains every batch up to ``position``.

        ``position`` defaults to the newest one in the table, taken before the report
        is written. Buckets of the report are overwritten first, buckets that it has
        no row in are dropped last; a report that fails to compute changes nothing.
        """
        spark = report.sparkSession
        epoch, batch = position if position is not None else self.position(spark)
        replay_epoch, replay_batch = self.position(spark, REPLAY)
        fences = zip(FENCE_COLUMNS, (epoch, batch, replay_epoch, replay_batch))
        rows = report.select(
            *REPORT_COLUMNS, *[F.lit(v).cast("bigint").alias(c) for c, v in fences], self._bucket("region_id")
        ).persist()
        try:
            filled = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
            if filled:
                self._write(rows)
        finally:
            rows.unpersist()
        for row in spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            if int(row["partition"].partition("=")[2]) not in filled:
                spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({row['partition']})")

    def upsert(self, delta_rows: DataFrame, position: tuple[int, int], lane: str = STREAM) -> tuple[int, int]:
        """Apply one batch of delta rows; returns ``(delta rows, rows changed)``.

        Matched rows get the dead change and a rate from the stored total; regions
        seen first are inserted, as :func:`regiontally.operators.deltas.fold` states.
        Two jobs: the delta rows are computed once and their buckets listed (at most
        ``buckets`` numbers), then these buckets are rewritten, which an observation
        counts. No delta rows: nothing is read or written. Rows changed are fewer
        than the delta rows when a replay meets rows that have the batch already.
        """
        spark = delta_rows.sparkSession
        d = delta_rows.select(*DELTA_COLUMNS, self._bucket("effective_region_id")).persist()
        try:
            found = d.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
            if not found:
                return 0, 0
            touched = sorted(row["bucket"] for row in found)
            changed = Observation()
            merged = self._merged(self.rows(spark).where(F.col("bucket").isin(touched)), d, position, lane)
            merged = merged.observe(changed, F.expr("count_if(fresh) AS n"))
            self._write(merged)
            return sum(row["n"] for row in found), int(changed.get["n"])
        finally:
            d.unpersist()

    def upsert_view(self, spark: SparkSession, view: str, position: tuple[int, int], lane: str = STREAM) -> tuple[int, int]:
        """:meth:`upsert` of the delta rows of a temporary view."""
        return self.upsert(spark.sql(f"SELECT {', '.join(DELTA_COLUMNS)} FROM {view}"), position, lane)

    def _merged(self, old: DataFrame, d: DataFrame, position: tuple[int, int], lane: str) -> DataFrame:
        epoch, batch = (int(v) for v in position)
        at_epoch, at_batch = (f"coalesce(r.{c}, -1L)" for c in FENCES[lane])
        later = f"({epoch}L > {at_epoch} OR ({epoch}L = {at_epoch} AND {batch}L > {at_batch}))"
        r = old.withColumn("stored", F.lit(True)).alias("r")
        d = d.withColumn("given", F.lit(True)).hint("shuffle_hash").alias("d")
        joined = r.join(d, F.expr("r.bucket = d.bucket AND r.region_id = d.effective_region_id"), "full_outer")
        marked = joined.selectExpr(
            "r.*",
            "d.*",
            "coalesce(r.bucket, d.bucket) AS of_bucket",
            f"given IS NOT NULL AND (stored IS NULL OR {later}) AS fresh",
        )

        def pick(kept: str, inserted: str) -> str:
            return f"CASE WHEN stored THEN {kept} ELSE {inserted} END"

        fences = []
        for name, columns in FENCES.items():
            for column, value in zip(columns, (epoch, batch) if name == lane else BEFORE_ALL):
                new = f"CASE WHEN fresh THEN {value}L ELSE {column} END" if name == lane else column
                fences.append(f"{pick(new, f'{value}L')} AS {column}")
        applied = marked.selectExpr(
            f"{pick('region_id', 'effective_region_id')} AS region_id",
            f"{pick('region_name', 'effective_region_name')} AS region_name",
            f"""{pick('region_type', f"'{REGION}'")} AS region_type""",
            f"{pick('parent_country_id', 'parent_country_id_source')} AS parent_country_id",
            f"{pick('total_population', 'total_population_change')} AS total_population",
            f"{pick('dead_population + IF(fresh, dead_population_change, 0L)', 'dead_population_change')} AS dead_population",
            "mortality_rate_percent AS stored_rate",
            *fences,
            "of_bucket AS bucket",
            "fresh",
        )
        rate = mortality_rate_sql(arithmetic=self.rate_arithmetic)
        return applied.withColumn("mortality_rate_percent", F.expr(f"CASE WHEN fresh THEN {rate} ELSE stored_rate END"))
