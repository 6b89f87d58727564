"""Connected components of an edge table, by repeated contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiontally.llm.common import cut, release


def contract(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Merge the classes that ``edges`` (a, b: labels) connect.

    ``labels`` is (node, comp) with comp the smallest node of its class; so is
    the result. Each step points every label at the smallest label next to it
    and rewrites the edges to the new labels, until no edge joins two labels.
    Hubs cost nothing extra: the minimum is combined before the shuffle.
    """
    edges = cut(edges.select("a", "b").filter("a <> b").distinct())
    steps = []
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = cut(both.groupBy(F.col("a").alias("comp")).agg(F.min("b").alias("low")).filter("low < comp"))
        steps.append(step)
        rest = edges
        for side in ("a", "b"):
            moved = step.select(F.col("comp").alias(side), "low")
            rest = rest.join(moved, side, "left").withColumn(side, F.coalesce("low", side)).drop("low")
        old, edges = edges, cut(rest.select("a", "b").filter("a <> b").distinct())
        release(old)
    release(edges)
    if not steps:
        return labels
    out = labels
    for step in steps:
        out = out.join(step, "comp", "left").select("node", F.coalesce("low", "comp").alias("comp"))
    out = cut(out)
    release(labels, *steps)
    return out
