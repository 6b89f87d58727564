"""Read the physical plan Spark chose: counts of scans, shuffles and join strategies.

After an action has run on a DataFrame, its plan is the final adaptive plan
(``isFinalPlan=true``), i.e. the strategies actually used at run time.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

OPERATORS = {
    "file_scans": r"\bFileScan \w+|\bScan parquet\b",
    "hash_shuffles": r"Exchange hashpartitioning",
    "range_shuffles": r"Exchange rangepartitioning",
    "broadcasts": r"BroadcastExchange",
    "broadcast_joins": r"BroadcastHashJoin",
    "sort_merge_joins": r"SortMergeJoin",
    "shuffled_hash_joins": r"ShuffledHashJoin",
    "reused_exchanges": r"ReusedExchange",
    "codegen_stages": r"\*\(\d+\)|WholeStageCodegen",
}


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The ``explain`` text of ``df`` (same as ``df.explain(mode)`` prints)."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def physical_plan(df: DataFrame) -> str:
    """The physical plan tree: the final adaptive plan if an action already ran (the
    initial plan that the adaptive node also prints is cut off), else the initial one."""
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in text:
        text = text.split("== Initial Plan ==", 1)[0].rstrip().removesuffix("+-").rstrip() + "\n"
    return text


def operator_counts(df: DataFrame) -> Counter:
    text = physical_plan(df)
    return Counter({name: len(re.findall(pattern, text)) for name, pattern in OPERATORS.items()})


def scans_of(df: DataFrame, path_fragment: str) -> list[str]:
    """Scan nodes whose location contains ``path_fragment`` (with their ReadSchema and filters)."""
    return [line for line in physical_plan(df).splitlines() if "FileScan" in line and path_fragment in line]
