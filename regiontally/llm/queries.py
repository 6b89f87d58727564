"""Registered queries of this package: ``opN_<name>(spark, sf_dir)`` over whole tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from regiontally.llm.chat_format import OP2_SQL, op2_chat_format
from regiontally.llm.decontaminate import op9_decontaminate
from regiontally.llm.gam_quality import op4_gam_quality
from regiontally.llm.html_extract import op10_html_extract
from regiontally.llm.lm_scoring import op6_lm_scoring
from regiontally.llm.mixing import OP7_SQL, op7_mix_sources
from regiontally.llm.ngram_jaccard import op1_ngram_jaccard
from regiontally.llm.prefix_trie import op11_prefix_trie
from regiontally.llm.quality_rules import op5_quality_rules
from regiontally.llm.spelling_variants import op12_spelling_variants
from regiontally.llm.suffix_dedup import op3_suffix_dedup
from regiontally.llm.token_counts import op8_token_counts
from regiontally.llm.toxicity import op13_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, unless they find it by themselves.

    They do when the repository is on PYTHONPATH or is the folder the application
    was started in; with ``--py-files`` neither is needed.
    """
    root, sc = Path(__file__).resolve().parents[2], spark.sparkContext
    found = str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or Path.cwd() == root
    if found or not (root / "regiontally").is_dir() or getattr(sc, "_regiontally_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="regiontally-code-")) / "regiontally.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "regiontally").rglob("*.py")):
            out.write(file, file.relative_to(root))
    sc.addPyFile(str(archive))  # Spark serves the archive to every executor
    sc._regiontally_shipped = True


def shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_chat_format": op2_chat_format,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_gam_quality": op4_gam_quality,
        "op5_quality_rules": op5_quality_rules,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_mix_sources": op7_mix_sources,
        "op8_token_counts": op8_token_counts,
        "op9_decontaminate": op9_decontaminate,
        "op10_html_extract": op10_html_extract,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_toxicity": op13_toxicity,
    }
    return {name: shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_format": OP2_SQL, "op7_mix_sources": OP7_SQL}
