"""Join strategies with a checked size and a skew-safe fallback.

``broadcast`` is applied only to a relation whose size has been measured
(:func:`measure`) or bounded from its source (the region lookup, see
``hierarchy.lookup_size_bound``) against a threshold. When the dimension side
is too large to broadcast, the
join is a shuffle join, but keys that hold more than one partition's fair
share of the large side ("hot" keys) are dealt over salts, with their dimension
rows replicated once per salt. At most ``partitions`` keys can be hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructType

from regiontally.session import checkpoint_root

# Bytes assumed per row on top of the payload (UnsafeRow header, null bits, hash entry).
ROW_OVERHEAD_BYTES = 48
# A region tree of a million districts bounds at ~150 MB: broadcasting it to every
# executor is far cheaper than shuffling billions of users, and fits executor and
# driver memory comfortably. Set spark.regiontally.broadcastMaxBytes to change it.
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024
BROADCAST_MAX_BYTES_CONF = "spark.regiontally.broadcastMaxBytes"


@dataclass(frozen=True)
class RelationSize:
    rows: int
    bytes: int


def _payload_bytes(schema: StructType):
    parts = []
    for f in schema.fields:
        if isinstance(f.dataType, StringType):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif isinstance(f.dataType, BooleanType):
            parts.append(F.lit(1))
        else:
            parts.append(F.lit(8))
    return sum(parts[1:], parts[0]) if parts else F.lit(0)


def measure(df: DataFrame) -> RelationSize:
    """Exact row count and estimated in-memory bytes of ``df``, in one aggregate job."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_payload_bytes(df.schema) + F.lit(ROW_OVERHEAD_BYTES)), F.lit(0)).alias(
            "bytes"
        ),
    ).first()
    return RelationSize(int(row["rows"]), int(row["bytes"]))


def broadcast_limit(df: DataFrame, max_bytes: int | None = None) -> int:
    if max_bytes is not None:
        return max_bytes
    conf = df.sparkSession.conf.get(BROADCAST_MAX_BYTES_CONF, None)
    return int(conf) if conf else DEFAULT_BROADCAST_MAX_BYTES


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the measured size of ``df`` is within the broadcast limit."""
    return measure(df).bytes <= broadcast_limit(df, max_bytes)


SALT = "_salt"


def hot_keys(big: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Keys that hold more than ``rows / partitions`` rows, with the number of ``salts`` to deal each over.

    One pass over the key columns, combined map-side: one row per key per task is
    shuffled, not the relation. The hot counts sum to at most all rows, so there
    are at most ``partitions`` such keys; the result is cut from its lineage in the
    shared checkpoint folder.
    """
    keys = list(keys)
    spark = big.sparkSession
    parts = max(1, partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    checkpoint_root(spark)
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).persist()
    try:
        total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first()["n"]
        share = max(1, int(total) // parts)
        hot = counts.where(F.col("_rows") > share)
        return hot.selectExpr(*keys, f"CAST(ceil(_rows / {share}) AS INT) AS _salts").checkpoint()
    finally:
        counts.unpersist()


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    partitions: int | None = None,
) -> DataFrame:
    """Inner equi-join of a large relation with a dimension too large to broadcast.

    ``small`` must be unique on ``keys``. A hot key of ``big`` (:func:`hot_keys`) is
    dealt over as many salts as it holds shares of a partition, and its dimension
    row is replicated once per salt (at most ``2 * partitions`` extra rows); all
    other keys have the one salt 0. The join is one shuffle join on the keys and
    the salt, in which no key exceeds a partition's share by more than the
    unevenness of a hash, and it reads the large relation once; the count of the
    keys before it is a second, narrow read of the key columns only.

    The salt is a hash of the row and of the task that reads it: it is the same
    when a task is run again, and copies of one row fall apart over the tasks.
    """
    keys = list(keys)
    hot = F.broadcast(hot_keys(big, keys, partitions))
    payload = [F.col(c) for c in big.columns]
    dealt = F.pmod(F.xxhash64(*payload, F.spark_partition_id()), F.coalesce(F.col("_salts"), F.lit(1)))
    left = big.join(hot, keys, "left").withColumn(SALT, dealt.cast("int")).drop("_salts")
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    right = small.join(hot, keys, "left").withColumn(SALT, F.explode(salts)).drop("_salts")
    if partitions:
        left, right = left.repartition(partitions, *keys, SALT), right.repartition(partitions, *keys, SALT)
    return left.join(right, [*keys, SALT], "inner").drop(SALT)


def dimension_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    max_bytes: int | None = None,
    broadcast: bool | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Inner join with a dimension: broadcast if its measured size allows, else salted.

    ``broadcast`` passes a decision already taken on a measurement (for example
    once per stream for a cached snapshot); ``None`` measures now.
    """
    if broadcast is None:
        broadcast = fits_broadcast(small, max_bytes)
    if broadcast:
        return big.join(F.broadcast(small), list(keys), "inner")
    return salted_join(big, small, keys, partitions)
