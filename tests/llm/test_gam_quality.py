from __future__ import annotations

import numpy as np

from regiontally.llm.gam_quality import FEATURES, crc_fold, features, fit, keep_quality, op4_gam_quality, score_quality
from tests.conftest import SF001

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    rows = op4_gam_quality(spark, SF001).collect()
    assert len(rows) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert all(r.held_out == (crc_fold(r.doc_id) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_pairs_learn_an_interaction():
    rng = np.random.RandomState(0)
    x = np.zeros((2000, len(FEATURES)))
    x[:, :2] = rng.rand(2000, 2)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x, y, n_pairs=1)
    assert model.pairs == [(0, 1)]
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.9


def test_scores_depend_on_the_text_alone(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (6, 1, 0), (7, None, 0), (None, 1, 0), (8, 0, 1)], LABELS)
    got = score_quality(odd_docs, labels).collect()
    assert len(got) == odd_docs.count()
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1
    kept = keep_quality(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r.predicted for r in got)
    assert score_quality(no_docs, labels).count() == 0
    assert {r.score for r in score_quality(odd_docs, labels.filter("1 = 0")).collect()} == {0.5}


def test_features_of_empty_texts_are_defined():
    assert np.isfinite(features([b"", b" ", b"one"])).all()
