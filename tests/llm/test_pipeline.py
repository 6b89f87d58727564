from __future__ import annotations

import corpus_pipeline
from regiontally.llm.gam_quality import op4_gam_quality
from regiontally.llm.ngram_jaccard import op1_ngram_jaccard
from tests.conftest import SF001


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], SF001).cache())
        assert seen[-1].columns == docs.columns
    ids = [sorted(r.doc_id for r in d.select("doc_id").collect()) for d in seen]
    rejected = {r.doc_id for r in op4_gam_quality(spark, SF001).collect() if r.predicted == 0}
    assert ids[1] == sorted(set(ids[0]) - rejected)
    # one document of each group stays: every component of what came in has one row left
    assert len(ids[2]) == len(set(ids[2])) and set(ids[2]) < set(ids[1])
    assert set(ids[3]) <= set(ids[2]) and set(ids[4]) < set(ids[3])
    changed = seen[3].join(seen[2].select("doc_id", seen[2]["text"].alias("before")), "doc_id").filter("text <> before")
    assert changed.count() > 0 and changed.filter("n_chars <> length(text)").isEmpty()
    out = corpus_pipeline.run(spark, SF001)
    assert set(docs.columns) < set(out.columns)
    assert {r.doc_id for r in out.select("doc_id").collect()} <= set(ids[4])
    assert op1_ngram_jaccard(spark, SF001).count() == docs.count()
