"""Toxicity: the grammar by hand-made clauses, its composition, learning, and held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from regiontally.llm import toxicity as tx
from regiontally.llm.common import table
from tests.conftest import SF001

LABELS = "doc_id long, quality int, toxic int"


def score(text, lexicon=None):
    return sum(tx.clause_score(s, w) for s, w, _ in tx.Reader(lexicon or tx.Lexicon()).clauses(text))


def test_clauses_are_judged_in_context():
    plain = score("what an idiot")
    assert plain == tx.SEED_WEIGHT and score("what a fine day") == 0
    assert score("you are an idiot") > plain > score('he said "an idiot" came') > 0
    assert score("not an idiot") < score("he said an idiot came") < plain
    assert score("never. an idiot") == plain  # a negation ends with its clause
    assert score("not one of all of them was an idiot") > score("not an idiot")  # and reaches a few words only
    assert score("i will kill you") > 0 and score("i will kill the lights") == 0
    assert score("i will kill. you") == 0 and score("i did not say that i kill them") > 0
    assert score("idiot moron") == 2 * plain
    assert score("IDIOT!") == plain and score("idiotic") == 0


def test_composition_equals_running_the_parts_side_by_side():
    parts = [tx.insult_machine(), tx.threat_machine(), tx.target_machine(), tx.negation_machine(), tx.report_machine()]
    rng = random.Random(1)
    for _ in range(300):
        states, at = [0] * len(parts), 0
        for symbol in [rng.randrange(8) for _ in range(40)]:
            marks = 0
            for i, part in enumerate(parts):
                states[i], mark = part.moves[states[i]][symbol]
                marks |= mark
            at, found = tx.GRAMMAR.moves[at][symbol]
            assert found == marks
    assert len(tx.GRAMMAR.moves) <= 1 * 4 * 2 * 4 * 4


def test_learned_entries_weigh_words_and_their_beginnings():
    lexicon = tx.Lexicon(100, 1000, {"grumb": (40, 0), "grumbx$": (50, 1), "rare": (3, 400)})
    assert lexicon.weight("grumbling") == lexicon.odds((40, 0)) > tx.MIN_ODDS
    assert lexicon.weight("grumbx") == lexicon.odds((50, 1))
    assert lexicon.weight("rareness") == 0 and lexicon.weight("gru") == 0
    assert lexicon.weight("grumbling", 1) < lexicon.weight("grumbling")
    assert tx.Lexicon(10, 10, {"once": (2, 0)}).weight("onces", 1) == 0  # its own document is not counted


def test_held_out_accuracy_and_contract(spark):
    rows = tx.op13_toxicity(spark, SF001)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    got = {r.doc_id: r for r in rows.collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    known = [(got[r.doc_id], r.toxic) for r in labels.collect()]
    held = [(r, t) for r, t in known if r.held_out]
    assert np.mean([r.predicted == t for r, t in held]) >= 0.95
    assert sum(r.predicted for r, t in held if t == 0) <= 1  # clean documents are left alone
    # held-out labels play no part
    flipped = labels.withColumn("toxic", F.when(tx.fold_of(F.col("doc_id")) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in tx.score_toxicity(docs, flipped).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_a_vocabulary_of_its_own_is_learned(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(300):
        toxic = i % 4 == 0
        said = [rng.choice(words) for _ in range(30)]
        if toxic:
            for _ in range(3):
                said[rng.randrange(30)] = "zorgl" + rng.choice(["a", "en", "ier"])
        docs.append((i, " ".join(said) + ".", "xx"))
        labels.append((i, 1, int(toxic)))
    found = tx.score_toxicity(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, LABELS))
    held = [(r.predicted, r.doc_id % 4 == 0) for r in found.collect() if r.held_out]
    assert np.mean([p == t for p, t in held]) >= 0.97


def test_copies_of_one_toxic_text_teach_nothing(spark):
    text = "blorf snark quibble wuggish the thing of things"
    rows = [(i, text, 1) for i in range(50)] + [(100 + i, f"other words {i} entirely", 0) for i in range(50)]
    assert tx.learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string, toxic int")).entries == {}


def test_the_sample_is_bounded_also_for_repeated_ids(spark):
    docs = spark.createDataFrame([(2, f"text {i}") for i in range(500)] + [(3, "a")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1, 1), (2, 1, 0), (3, 1, 0)], LABELS)
    assert tx.training_rows(docs, labels, 40).count() <= 40
    rows = {(r.doc_id, r.toxic) for r in tx.training_rows(docs, labels).collect()}
    assert rows <= {(2, 1), (3, 0)}


@pytest.mark.parametrize("with_labels", [True, False])
def test_odd_input(spark, odd_docs, no_docs, with_labels):
    rows = [(1, 1, 1), (2, None, None), (None, 1, 1), (2, 0, 0), (77, 1, 1)] if with_labels else []
    labels = spark.createDataFrame(rows, LABELS)
    got = tx.score_toxicity(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score < 0.7 and r.predicted == 0 for r in got)
    empty = {r.score for r in got if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1
    assert tx.score_toxicity(no_docs, labels).isEmpty()
    toxic = spark.createDataFrame([(1, "you idiot. you moron. " + "fine words " * 3), (2, "idiot " * 50_000)], "doc_id long, text string")
    assert {r.doc_id for r in tx.score_toxicity(toxic, labels).collect() if r.predicted} == {1, 2} or with_labels
