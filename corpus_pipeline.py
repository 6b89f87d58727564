"""Corpus pipeline: documents -> a cleaned, deduplicated, decontaminated training mix.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regiontally.llm.common import cut
from regiontally.llm.decontaminate import drop_leaks
from regiontally.llm.gam_quality import keep_quality
from regiontally.llm.mixing import mix_sources
from regiontally.llm.ngram_jaccard import keep_one_per_group
from regiontally.llm.queries import ship_package
from regiontally.llm.suffix_dedup import drop_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest doc_id."""
    return keep_one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 (``PASSAGE``) that occur more than once are taken out of the texts."""
    return drop_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exact or edited, go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights, in global random order."""
    return mix_sources(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources", mix),
]

# The fitted classifier and the alignment have no SQL form; tests/llm checks run() stage by stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read back for the next."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
