from __future__ import annotations

import random

import numpy as np

from regiontally.llm.common import distinct_sorted, shingles
from regiontally.llm.ngram_jaccard import jaccard_components, jaccard_links, keep_one_per_group, op1_ngram_jaccard, overlaps, suffix_bound
from tests.conftest import SF0001


def word_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(docs):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {i: word_set(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def brute_links(docs):
    """{doc_id: number of linked documents} by comparing all pairs."""
    sets = {i: word_set(t) for i, t in docs}
    return {
        a: sum(100 * len(x & y) >= 75 * len(x | y) for b, y in sets.items() if b != a and x and y) for a, x in sets.items()
    }


def test_query_matches_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    rows = op1_ngram_jaccard(spark, SF0001).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs)
    assert {r.doc_id: r.n_links for r in rows} == brute_links(docs)


def test_links_are_counted_alike_in_blocks_of_any_size(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for group in range(4):
        base = [rng.choice(words) for _ in range(70)]
        for i in range(12):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(70)] = f"z{rng.randrange(6)}"
            docs += [(len(docs) + k, " ".join(text)) for k in range(rng.choice([1, 1, 3]))]
    docs += [(-5, "one two"), (-6, "one two"), (-7, ""), (-8, None), (-9, "alone")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = brute_links(docs)
    assert max(want.values()) > 5
    for sizes in ({}, {"block_sets": 3}, {"block_bytes": 1200}):
        rows = jaccard_links(frame, **sizes).collect()
        assert {r.doc_id: r.n_links for r in rows} == want
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs)


def test_overlaps_in_column_steps():
    rng = np.random.RandomState(1)
    left, right = ([np.unique(rng.randint(0, 80, rng.randint(1, 40)).astype(np.uint64)) for _ in range(k)] for k in (7, 5))
    for columns in (3, 4096):
        got = overlaps(left, right, columns)
        assert got.tolist() == [[len(np.intersect1d(x, y)) for y in right] for x in left]
    assert overlaps([np.array([1], dtype=np.uint64)], [np.array([2], dtype=np.uint64)]).tolist() == [[0]]


def test_chains_and_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(80)]
    docs = []
    for i in range(60):  # a drifting chain: neighbours are alike, the ends are not
        if i % 3 == 0:
            base = list(base)
            base[rng.randrange(80)] = f"x{i}"
        docs.append((i, " ".join(base)))
    docs += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    rng.shuffle(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)


def test_hot_shingles_keep_negative_and_huge_ids(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(60)]
    texts = []
    for i in range(12):  # each near the base, not equal
        text = list(base)
        text[rng.randrange(60)] = f"y{i}"
        texts.append(" ".join(text))
    docs = [(i, t) for i, t in zip([-1, -2, -(1 << 62), 0, 3, (1 << 62), -7, 8, -9, 10, -11, 12], texts)]
    frame = spark.createDataFrame([*docs, (None, texts[0])], "doc_id long, text string")
    for heavy in (None, 1):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(frame, heavy=heavy).collect()}
        assert got.pop(None)[1] is None
        assert got == brute(docs)


def test_odd_rows(odd_docs, no_docs):
    got = jaccard_components(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    n = len(word_set(odd_docs.filter("doc_id = 2").first().text))
    assert by_id[(1, n)] == 1 and by_id[(2, n)] == 1
    assert by_id[(3, 0)] == 3 and by_id[(4, 0)] == 4 and by_id[(5, 0)] == 5
    assert by_id[(None, n)] is None
    assert {c for (i, _), c in by_id.items() if i in (6, 7)} == {6}
    assert jaccard_components(no_docs).count() == 0
    assert jaccard_links(no_docs).count() == 0
    rows = jaccard_links(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    # the rows of documents 1 and 2 that hold the same prose link with each other, the row without id with nothing
    links = sorted((r.doc_id or -1, r.n_shingles, r.n_links) for r in rows)
    assert links.count((1, n, 2)) == 2 and (2, n, 2) in links and (-1, n, 0) in links
    assert (3, 0, 0) in links and {x[2] for x in links if x[0] in (6, 7)} == {1}
    kept = keep_one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 3, 4, 5, 6, 8]
    assert keep_one_per_group(no_docs).count() == 0


def test_suffix_bound_never_too_low():
    rng = np.random.RandomState(0)
    for _ in range(50):
        x, y = (np.unique(rng.randint(0, 60, rng.randint(0, 40)).astype(np.uint64)) for _ in range(2))
        assert suffix_bound(x, y, 3) >= len(np.intersect1d(x, y))


def test_shingles_of_short_and_empty_texts():
    hashes, cuts = distinct_sorted(*shingles([b"", b"a b", b"A  b\n", b"a b c d e f", b" "]))
    assert np.diff(cuts).tolist() == [0, 1, 1, 2, 0]
    assert hashes[0] == hashes[1]
