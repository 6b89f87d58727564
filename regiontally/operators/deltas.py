"""Per-batch population deltas and the closed-form fold of the additive upsert.

A micro-batch of user change rows yields one delta row per REGION it touches:
``count(user)`` and ``count(user where active = false)`` over the distinct
``(user, active, region)`` rows of that batch. These are plain counts: a repeated
event for the same inactive user adds again and a reactivation subtracts nothing.

The report table is updated as by an upsert keyed on ``region_id``:

* matched: ``dead += Δdead`` and the rate is recomputed from the *stored*
  total; name, type, parent and total are never changed;
* not matched: the delta row is inserted (total, dead, name and parent from it).

Because totals and descriptive columns are frozen at first sight and ``dead``
only accumulates, the state after any sequence of batches has a closed form,
computed by :func:`fold` from the baseline and the log of delta rows:

* REGION in the baseline: ``total = baseline.total``,
  ``dead = baseline.dead + Σ Δdead``; untouched rows are returned unchanged;
* REGION not in the baseline: total, name and parent of its earliest delta
  (ordered by ``(epoch, batch_id)``), ``dead = Σ Δdead``;
* ``rate = dead * 100.0 / total`` if ``total > 0`` else ``0.0``.

The fold is a grouped aggregate over the log (partial aggregation first) and one
full outer join of two relations with one row per REGION. Replaying a batch
rewrites its own log entry, so the fold is idempotent under replay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiontally.functions.expressions import mortality_rate_sql
from regiontally.operators.aggregate import population_counts
from regiontally.schemas import REGION, REPORT_COLUMNS

DELTA_COLUMNS = [
    "effective_region_id",
    "effective_region_name",
    "total_population_change",
    "dead_population_change",
    "parent_country_id_source",
]
ORDER_COLUMNS = ["epoch", "batch_id"]


def region_names(report_base: DataFrame) -> DataFrame:
    """REGION id → name and parent, in the column names of a delta row."""
    return report_base.selectExpr(
        "region_id AS effective_region_id",
        "region_name AS effective_region_name",
        "parent_country_id AS parent_country_id_source",
    )


def deltas(
    resolved: DataFrame,
    report_base: DataFrame,
    keys: Sequence[str] = (),
    bounded: bool = False,
) -> DataFrame:
    """Delta rows of resolved change rows, per ``keys`` (e.g. ``batch_id``) and REGION.

    The counts are computed on ids only; name and parent are joined back on the
    aggregated rows (one per REGION per key), so they never ride the shuffle.
    With ``bounded`` (the tree is proven small) the REGION names are broadcast. A
    REGION without a name row keeps its counts (name and parent are then NULL).
    """
    keys = list(keys)
    counts = population_counts(
        resolved,
        [*keys, "effective_region_id"],
        total_name="total_population_change",
        dead_name="dead_population_change",
    )
    names = region_names(report_base)
    return counts.join(F.broadcast(names) if bounded else names, "effective_region_id", "left").selectExpr(
        *keys, *DELTA_COLUMNS
    )


def fold(
    log: DataFrame,
    baseline: DataFrame | None = None,
    after: tuple[int, int] | None = None,
    rate_arithmetic: str = "double",
) -> DataFrame:
    """Report after applying every delta of ``log`` to ``baseline`` in ``(epoch, batch_id)`` order.

    ``log`` has ``epoch, batch_id`` and the delta columns; ``baseline`` has the
    seven report columns (``None``: an empty table). With ``after``, log rows at
    or before that position are already contained in the baseline and skipped.
    ``rate_arithmetic="decimal"`` computes the rates of touched rows exactly as
    the original upsert statement did (decimal, then stored as double; they
    differ from the double rate by at most ~1.5e-14).
    """
    rate_sql = mortality_rate_sql(arithmetic=rate_arithmetic)
    if after is not None:
        # Lexicographic (epoch, batch_id) > after; on a partitioned log this prunes folders.
        epoch, batch = (int(v) for v in after)
        log = log.where(f"epoch > {epoch} OR (epoch = {epoch} AND batch_id > {batch})")
    applied = log.groupBy("effective_region_id").agg(
        F.expr("sum(dead_population_change) AS dead_sum"),
        F.expr(
            "min_by(named_struct('total', total_population_change, 'name', effective_region_name, "
            "'parent', parent_country_id_source), named_struct('epoch', epoch, 'batch_id', batch_id)) AS first"
        ),
    )
    if baseline is None:
        inserted = applied.selectExpr(
            "effective_region_id AS region_id",
            "first.name AS region_name",
            f"'{REGION}' AS region_type",
            "first.parent AS parent_country_id",
            "first.total AS total_population",
            "dead_sum AS dead_population",
        )
        return inserted.selectExpr(*REPORT_COLUMNS[:-1], f"{rate_sql} AS mortality_rate_percent")

    b = baseline.select(*REPORT_COLUMNS).alias("b")
    # Both sides have one row per REGION; a hash join needs no sort of either side.
    a = applied.hint("shuffle_hash").alias("a")
    joined = b.join(a, F.expr("b.region_id = a.effective_region_id"), "full_outer")
    matched = "b.region_id IS NOT NULL"
    merged = joined.selectExpr(
        "coalesce(b.region_id, a.effective_region_id) AS region_id",
        f"CASE WHEN {matched} THEN b.region_name ELSE a.first.name END AS region_name",
        f"CASE WHEN {matched} THEN b.region_type ELSE '{REGION}' END AS region_type",
        f"CASE WHEN {matched} THEN b.parent_country_id ELSE a.first.parent END AS parent_country_id",
        f"CASE WHEN {matched} THEN b.total_population ELSE a.first.total END AS total_population",
        f"CASE WHEN {matched} THEN b.dead_population + coalesce(a.dead_sum, 0L) ELSE a.dead_sum END"
        " AS dead_population",
        "a.effective_region_id IS NOT NULL AS touched",
        "b.mortality_rate_percent AS stored_rate",
    )
    # Untouched rows keep their stored rate; touched rows recompute it from the stored total.
    return merged.selectExpr(
        *REPORT_COLUMNS[:-1],
        f"CASE WHEN touched THEN {rate_sql} ELSE stored_rate END AS mortality_rate_percent",
    )
