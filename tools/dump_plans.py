"""Write the final adaptive physical plans of the headline queries to PLANS.md.

Usage: python tools/dump_plans.py [sf_dir] [out_path]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regiontally.plans.inspect import operator_counts, physical_plan  # noqa: E402
from regiontally.queries import queries  # noqa: E402
from regiontally.session import local_session  # noqa: E402

KEYS = ["mortality_report", "batch_deltas_with_parent", "report_after_stream_with_baseline"]


def _clean(plan: str) -> str:
    # Expression ids and scratch-folder paths change between runs.
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"\[file:[^\]]*/testdata/(\w+)/[0-9a-f]+\]", r"[<shared>/testdata/\1]", plan)
    plan = re.sub(r"plan_id=\d+", "plan_id=…", plan)
    return plan


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = local_session(**{"spark.ui.showConsoleProgress": "false"})
    parts = [
        "# Executed plans\n",
        f"Final adaptive physical plans after one run at `{sf_dir}` on local[8] (generated by "
        "`tools/dump_plans.py`; expression ids and scratch paths elided).\n",
    ]
    for key in KEYS:
        df = queries()[key](spark, sf_dir)
        df.collect()
        counts = dict(operator_counts(df))
        parts.append(f"\n## {key}\n\n`{counts}`\n\n```\n{_clean(physical_plan(df)).rstrip()}\n```\n")
    with open(out, "w", encoding="utf-8") as fh:
        fh.write("".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
