from __future__ import annotations

import math
from collections import Counter

from regiontally.llm.mixing import mix_sources, op7_mix_sources
from tests.conftest import SF001


def test_counts_follow_the_target(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "if(id % 10 < 7, 'big', 'small') as source", "'x' as text")
    out = mix_sources(docs, weights={"big": 1.0, "small": 1.0}).collect()
    n = Counter(r.source for r in out)
    assert abs(n["big"] - 10_000) < 400 and abs(n["small"] - 10_000) < 400
    copies = Counter(r.doc_id for r in out if r.source == "small")
    mean = 10_000 / 6_000
    for k in range(4):
        p = math.exp(-mean) * mean**k / math.factorial(k)
        share = sum(v == k for v in copies.values()) / 6_000 if k else 1 - len(copies) / 6_000
        assert abs(share - p) < 0.03
    # shuffled: the order has nothing to do with the id
    assert len({r.mix_key for r in out}) == len(out)


def test_large_means_and_missing_sources(spark):
    docs = spark.range(1_000).selectExpr("id as doc_id", "if(id = 0, 'one', 'rest') as source", "'x' as text")
    out = mix_sources(docs, weights={"one": 1.0, "rest": 1.0})
    assert abs(out.filter("source = 'one'").count() - 500) < 120  # a mean of 500, drawn in parts
    assert mix_sources(docs, weights={"one": 1.0}).filter("source = 'rest'").count() == 0


def test_repeatable_and_whole(spark):
    a, b = (sorted((r.doc_id, r.copy) for r in op7_mix_sources(spark, SF001).collect()) for _ in range(2))
    assert a == b and len(set(a)) == len(a)


def test_odd_rows(odd_docs, no_docs):
    out = mix_sources(odd_docs, temperature=1.0)
    assert set(out.columns) == set(odd_docs.columns)
    assert mix_sources(no_docs).count() == 0
    many = mix_sources(odd_docs, weights={"": 1.0})
    assert {r.source for r in many.collect()} <= {None}
