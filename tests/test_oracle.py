"""Every registered query against its DuckDB oracle, at sf0.001 (the driver checks sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from regiontally.oracle import oracle_sql
from regiontally.queries import queries
from tests.conftest import SF0001
from tools.check_oracle import compare, duckdb_views

KEYS = sorted(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF0001)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    result = compare(spark, con, key, SF0001)
    assert result["ok"], result


def test_entry_flagship(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 26
    assert sum(r.total_population for r in rows) == 123
    assert sum(r.dead_population for r in rows) == 9
    assert (rows[0].region_id, rows[0].mortality_rate_percent) == ("R23", 100.0 / 3)
