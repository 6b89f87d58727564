"""Operator counts of the final (adaptive) plans of the headline queries.

Usage: python tools/plan_counts.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regiontally.plans.inspect import operator_counts  # noqa: E402
from regiontally.queries import queries  # noqa: E402
from regiontally.session import local_session  # noqa: E402

KEYS = ["mortality_report", "users_mapped", "batch_deltas_with_parent", "report_after_stream_with_baseline",
        "users_via_district"]
COLS = ["file_scans", "hash_shuffles", "range_shuffles", "broadcasts", "broadcast_joins", "sort_merge_joins",
        "shuffled_hash_joins", "reused_exchanges"]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(**{"spark.ui.showConsoleProgress": "false"})
    print("| query | " + " | ".join(COLS) + " |")
    print("| --- |" + " --- |" * len(COLS))
    for key in KEYS:
        df = queries()[key](spark, sf_dir)
        df.collect()
        c = operator_counts(df)
        print(f"| {key} | " + " | ".join(str(c[k]) for k in COLS) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
