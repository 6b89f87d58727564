"""The MERGE statement of the sink, applied batch by batch, equals the fold.

No catalog here supports row-level operations, so the statement is executed in
DuckDB (same SQL but for double literals) against the
batch report, one micro-batch of delta rows at a time, and compared with the
Spark fold of the same deltas.
"""

from __future__ import annotations

import re

import duckdb

from regiontally.plans import incremental
from regiontally.queries import queries
from regiontally.schemas import REPORT_COLUMNS
from regiontally.sinks.tables import merge_sql
from regiontally.sources import testdata as td
from tests.conftest import SF0001

DOUBLE = re.compile(r"(\d+\.\d+)D")  # Spark's double literals

DELTA_COLUMNS = [
    "effective_region_id",
    "effective_region_name",
    "total_population_change",
    "dead_population_change",
    "parent_country_id_source",
]


def test_merge_statement_sequence_equals_fold(spark):
    q = queries()
    baseline = q["mortality_report"](spark, SF0001).select(*REPORT_COLUMNS).toPandas()
    deltas = incremental.batch_deltas(td.user_events(spark, SF0001), td.regions(spark, SF0001), with_parent=True)
    delta_rows = deltas.toPandas()
    folded = q["report_after_stream_with_baseline"](spark, SF0001).select(*REPORT_COLUMNS).toPandas()

    con = duckdb.connect()
    con.register("baseline_df", baseline)
    con.execute("CREATE TABLE report AS SELECT * FROM baseline_df")
    con.register("deltas_df", delta_rows)
    for batch_id in sorted(delta_rows["batch_id"].unique()):
        con.execute(
            f"CREATE OR REPLACE TABLE source_deltas AS SELECT {', '.join(DELTA_COLUMNS)} "
            f"FROM deltas_df WHERE batch_id = {int(batch_id)}"
        )
        con.execute(DOUBLE.sub(r"CAST(\1 AS DOUBLE)", merge_sql("report", "source_deltas")))
    merged = con.execute(f"SELECT {', '.join(REPORT_COLUMNS)} FROM report").fetchall()

    def rows(records):
        return sorted(tuple(None if v != v else v for v in r) for r in records)

    assert rows(merged) == rows(folded.itertuples(index=False, name=None))
    assert len(merged) == 26
