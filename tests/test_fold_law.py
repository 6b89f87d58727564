"""Fold law: the closed-form fold equals applying the upserts one batch at a time.

The oracle is a plain-Python simulation of the keyed upsert (matched: add the
dead change, recompute the rate from the stored total; not matched: insert the
delta row), applied in ``(epoch, batch_id)`` order to random baselines and logs.
"""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from regiontally.operators.deltas import fold
from regiontally.schemas import REPORT_SCHEMA
from regiontally.streaming.delta_log import LOG_SCHEMA

IDS = ["R0", "R1", "R2", "R3", "R4"]


def _rate(dead, total):
    return dead * 100.0 / total if total > 0 else 0.0


def simulate(baseline, batches):
    table = {r[0]: list(r) for r in baseline}
    for (epoch, batch_id), rows in sorted(batches.items()):
        for rid, name, total, dead, parent in rows:
            if rid in table:
                t = table[rid]
                t[5] = t[5] + dead
                t[6] = _rate(t[5], t[4])
            else:
                table[rid] = [rid, name, "REGION", parent, total, dead, _rate(dead, total)]
    return {k: tuple(v) for k, v in table.items()}


baseline_rows = st.lists(
    st.tuples(st.sampled_from(IDS), st.integers(0, 6), st.integers(0, 9)),
    max_size=4,
    unique_by=lambda t: t[0],
).map(
    lambda rows: [
        (rid, f"base-{rid}", "REGION", f"C-{rid}", total, dead, _rate(dead, total)) for rid, total, dead in rows
    ]
)

batch_rows = st.lists(
    st.tuples(st.sampled_from(IDS), st.integers(0, 4), st.integers(0, 5)),
    max_size=4,
    unique_by=lambda t: t[0],
)

logs = st.dictionaries(
    st.tuples(st.integers(0, 2), st.integers(0, 5)),
    batch_rows,
    max_size=5,
).map(
    lambda d: {
        pos: [(rid, f"{rid}@{pos}", total, dead, f"P-{rid}@{pos}") for rid, total, dead in rows]
        for pos, rows in d.items()
    }
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(baseline=st.one_of(st.none(), baseline_rows), batches=logs)
def test_fold_equals_sequential_upserts(spark, baseline, batches):
    log_rows = [
        (rid, name, total, dead, parent, epoch, batch_id)
        for (epoch, batch_id), rows in batches.items()
        for rid, name, total, dead, parent in rows
    ]
    log = spark.createDataFrame(log_rows, LOG_SCHEMA)
    base_df = spark.createDataFrame(baseline, REPORT_SCHEMA) if baseline is not None else None
    got = {tuple(r): None for r in fold(log, base_df).collect()}
    expected = simulate(baseline or [], batches)
    assert {r[0]: r for r in got} == expected


def test_decimal_rate_matches_the_upsert_statement_arithmetic(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from regiontally.queries import queries
    from regiontally.sources import testdata as td
    from tests.conftest import SF0001

    from regiontally.plans import incremental

    baseline = queries()["mortality_report"](spark, SF0001)
    log = incremental.as_log(
        incremental.batch_deltas(td.user_events(spark, SF0001), td.regions(spark, SF0001), with_parent=True)
    )
    as_double = {r.region_id: r for r in fold(log, baseline).collect()}
    as_decimal = {r.region_id: r for r in fold(log, baseline, rate_arithmetic="decimal").collect()}
    assert as_double.keys() == as_decimal.keys()
    touched = {r.effective_region_id for r in log.select("effective_region_id").distinct().collect()}
    differing = 0
    for rid, row in as_decimal.items():
        total, dead = row.total_population, row.dead_population
        if rid in touched and total > 0:  # untouched rows keep their stored rate
            exact = (Decimal(dead) * Decimal("100.0") / Decimal(total)).quantize(
                Decimal("1e-14"), rounding=ROUND_HALF_UP
            )
            assert row.mortality_rate_percent == float(exact)
        assert abs(row.mortality_rate_percent - as_double[rid].mortality_rate_percent) <= 1e-12


def test_decimal_and_double_rates_differ_only_in_the_last_bits(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from regiontally.functions.expressions import mortality_rate_sql

    # Every (dead, total) with total in 1..60 and dead in 0..120, from one range.
    pairs = spark.range(0, 60 * 121).selectExpr(
        "CAST(id % 60 + 1 AS BIGINT) AS total_population", "CAST(id DIV 60 AS BIGINT) AS dead_population"
    )
    rows = pairs.selectExpr(
        "dead_population",
        "total_population",
        f"{mortality_rate_sql()} AS as_double",
        f"{mortality_rate_sql(arithmetic='decimal')} AS as_decimal",
    ).collect()
    differing = 0
    for r in rows:
        exact = (Decimal(r.dead_population) * Decimal("100.0") / Decimal(r.total_population)).quantize(
            Decimal("1e-14"), rounding=ROUND_HALF_UP
        )
        assert r.as_decimal == float(exact)
        assert abs(r.as_decimal - r.as_double) <= 1e-12
        differing += r.as_decimal != r.as_double
    assert 0 < differing < len(rows)
