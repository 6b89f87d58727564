from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from regiontally.llm.lm_scoring import score_cross_entropy


def brute(docs, targets, size, weight):
    words = {i: (t or "").lower().encode().split() for i, t in docs}
    counts = Counter(w for ws in words.values() for w in ws)
    assert len(counts) <= size

    def loss(ids, own):
        uni, bi = Counter(), Counter()
        for i in ids:
            if i != own:
                uni.update(words[i])
                bi.update(zip(words[i], words[i][1:]))
        total, out, ws = sum(uni.values()), 0.0, words[own]
        for k, w in enumerate(ws):
            p = (uni[w] + 1) / (total + size + 1)
            if k and uni[ws[k - 1]]:
                p = weight * bi[(ws[k - 1], w)] / uni[ws[k - 1]] + (1 - weight) * p
            out -= math.log(p)
        return out / len(ws)

    return {i: (loss(targets, i), loss(words, i)) if ws else None for i, ws in words.items()}


def test_matches_brute_force(spark):
    rng = random.Random(5)
    docs = []
    for i in range(120):
        pool = range(30) if i % 3 == 0 else range(20, 60)
        docs.append((i, " ".join(f"w{rng.choice(pool)}" for _ in range(rng.randrange(0, 60)))))
    targets = {i for i, _ in docs if i % 6 == 0}
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    chosen = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    expected = brute(docs, targets, 100, 0.7)
    alike, other = [], []
    for r in score_cross_entropy(frame, chosen, vocabulary_size=100).collect():
        if expected[r.doc_id] is None:
            assert r.n_tokens == 0 and r.score is None
            continue
        assert (r.target_loss, r.background_loss) == pytest.approx(expected[r.doc_id])
        assert r.score == pytest.approx(r.target_loss - r.background_loss)
        (alike if r.doc_id % 3 == 0 else other).append(r.score)
    assert sum(alike) / len(alike) < 0 < sum(other) / len(other)


def test_odd_rows(spark, odd_docs, no_docs):
    targets = spark.createDataFrame([(1,), (None,), (99,)], "doc_id long")
    got = score_cross_entropy(odd_docs, targets).collect()
    assert len(got) == odd_docs.count()
    assert all((r.score is None) == (r.n_tokens == 0) for r in got)
    assert score_cross_entropy(no_docs, targets).count() == 0
    assert score_cross_entropy(odd_docs, targets.filter("1 = 0")).count() == odd_docs.count()


def test_counts_stay_exact_beyond_any_fixed_table(spark):
    # more different words than the 65,535 of the former vocabulary, and bigrams that crowded its buckets
    docs = [(i, " ".join(f"r{i}x{k} common" for k in range(700))) for i in range(100)]
    targets = {i for i, _ in docs if i < 20}
    size = len({w for _, t in docs for w in t.split()})
    assert size > 70_000
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    chosen = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    expected = brute(docs, targets, size, 0.7)
    rows = score_cross_entropy(frame, chosen).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.target_loss, r.background_loss) == pytest.approx(expected[r.doc_id])


def test_small_blocks_give_the_same_counts(monkeypatch):
    import pyarrow as pa
    import pyarrow.compute

    from regiontally.llm import lm_scoring

    rng = random.Random(3)
    docs = [(i, " ".join(f"v{rng.randrange(50)}" for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    targets, words = {0, 7, 9}, Counter(w for _, t in docs for w in t.split())
    expected = brute(docs, targets, len(words), 0.7)
    task = type("Task", (), {"get": staticmethod(lambda: type("Context", (), {"partitionId": lambda self: 2})())})
    monkeypatch.setattr(lm_scoring, "TaskContext", task)
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 200)
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in docs], "text": [t.encode() for _, t in docs], "target": [i in targets for i, _ in docs]})
    blocks = list(lm_scoring._blocks([batch]))
    assert len(blocks) > 10
    counts = pa.Table.from_batches(list(lm_scoring._count_blocks(8)(blocks)))
    buckets = sorted(set(counts.column("bucket").to_pylist()))
    sums = pa.concat_tables(lm_scoring._sum_bucket(counts.filter(pa.compute.equal(counts.column("bucket"), b))) for b in buckets)
    known, said, wanted = (sum(sums.column(c).to_pylist()) for c in ("known", "said", "wanted"))
    assert (known, said, wanted) == (len(words), sum(words.values()), sum(len(t.split()) for i, t in docs if i in targets))
    for block in blocks:
        own = sums.filter(pa.compute.equal(sums.column("block"), block.column("block")[0]))
        for r in lm_scoring._score((wanted, said), known, 0.7)(pa.Table.from_batches([block]), own).to_pylist():
            if expected[r["doc_id"]] is not None:
                assert (r["target_loss"], r["background_loss"]) == pytest.approx(expected[r["doc_id"]])
