from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from regiontally.llm.suffix_dedup import drop_repeats, keep_bytes, op3_suffix_dedup, with_nested_spans, with_spans
from tests.conftest import SF0001


def covered(texts, length):
    """Which bytes of each text a string that occurs twice covers."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i : i + length] = True
        out.append(mark)
    return out


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    expected = {}
    for (i, t), mark in zip(rows, covered([t for _, t in rows], 400)):
        rest = bytes(np.frombuffer(t, dtype=np.uint8)[~mark])
        runs = int((np.diff(np.concatenate(([0], mark.astype(int)))) == 1).sum())
        expected[i] = (len(t), int(mark.sum()), runs, hashlib.sha256(rest).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op3_suffix_dedup(spark, SF0001).collect()}
    assert got == expected
    cut_text = {r.doc_id: r.text for r in op3_suffix_dedup(spark, SF0001).collect()}
    assert all(cut_text[i] == t.decode() for i, t in rows if not expected[i][1])
    assert all(len(cut_text[i].encode()) <= expected[i][0] - expected[i][1] for i, _ in rows)


@pytest.mark.parametrize("max_group", [4096, 1])
def test_shared_passages_periods_and_edges(spark, max_group):
    rng = random.Random(7)

    def noise(n):
        return "".join(rng.choice("abcd ") for _ in range(n))

    passage, length, anchor = noise(60), 40, 16
    texts = [noise(rng.randrange(0, 90)) + passage[rng.randrange(0, 20) :] + noise(rng.randrange(0, 90)) for _ in range(40)]
    texts += ["xy" * 50, "xyx" * 30, noise(39), passage, passage, texts[0], "é" * 45, "", texts[1][:60] + texts[2][:60]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.removed_spans for r in with_spans(frame, length, anchor, max_group).collect()}
    for i, mark in enumerate(covered([t.encode() for t in texts], length)):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mark.astype(int), [0]))))
        expected = [tuple(x) for x in edges.reshape(-1, 2).tolist()]
        assert [(s["start"], s["stop"]) for s in got[i] or ()] == expected, texts[i]


def test_a_common_passage_makes_one_join_row_an_occurrence(spark):
    """Every text around one passage differs, so each piece has many ranges; spans still are the brute-force ones."""
    rng = random.Random(9)

    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    passage = noise(100)
    texts = [noise(60) + passage + noise(60) for _ in range(50)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for max_group in (4096, 10):
        got = {r.doc_id: r.removed_spans for r in with_spans(frame, 40, 16, max_group).collect()}
        for i, mark in enumerate(covered([t.encode() for t in texts], 40)):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mark.astype(int), [0])))).reshape(-1, 2).tolist()
            assert [[s["start"], s["stop"]] for s in got[i]] == edges


def test_passages_of_over_fifty_words_go(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(2000)]
    passage = " ".join(rng.choice(words) for _ in range(51))
    docs = [(i, " ".join(rng.choice(words) for _ in range(80)) + " " + passage + " " + " ".join(rng.choice(words) for _ in range(80))) for i in range(6)]
    docs += [(100 + i, " ".join(rng.choice(words) for _ in range(100))) for i in range(6)]
    left = {r.doc_id: r.text for r in drop_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(passage not in left[i] and passage[20:200] not in left[i] for i in range(6))
    assert all(left[i] == t for i, t in docs if i >= 100)


def test_query_counts_passages_shorter_than_its_strings(spark, tmp_path):
    """51 shared words of about 300 bytes: nothing of 400 bytes to remove, but a repeated passage."""
    rng = random.Random(10)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(2000)]

    def some(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage = some(51)
    assert 200 < len(passage) < 350
    docs = [(i, f"{some(80)} | {passage} | {some(80)}") for i in range(4)]
    docs += [(10 + i, some(150)) for i in range(4)] + [(20, "é" * 250), (21, None), (22, "short")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op3_suffix_dedup(spark, str(tmp_path)).collect()}
    assert len(got) == len(docs)
    for i, mark in enumerate(covered([(t or "").encode() for _, t in docs], 200)):
        row = got[docs[i][0]]
        assert (row.n_passage_bytes, row.n_passages) == (mark.sum(), (np.diff(np.concatenate(([0], mark.astype(int)))) == 1).sum())
    assert all(got[i].n_removed == 0 and got[i].n_passage_bytes >= len(passage) and got[i].text == t for i, t in docs[:4])
    assert all(got[10 + i].n_passage_bytes == 0 for i in range(4))
    assert (got[20].n_removed, got[20].n_passage_bytes) == (500, 500)


@pytest.mark.parametrize("max_group", [4096, 1])
def test_nested_spans_are_those_of_both_lengths(spark, max_group):
    rng = random.Random(11)

    def noise(n):
        return "".join(rng.choice("abcd ") for _ in range(n))

    passage, short = noise(60), noise(25)
    texts = [noise(rng.randrange(0, 60)) + passage[rng.randrange(0, 40) :] + noise(rng.randrange(0, 60)) + short for _ in range(40)]
    # runs of the short length that hold a long string twice, once, across two runs, in one text, and in equal texts
    texts += ["xy" * 50, "xyx" * 30, passage, passage, texts[0], "é" * 45, "", noise(19), passage[:39] + short, short + "|" + passage + "|" + passage]
    frame = spark.createDataFrame([(None, t) for t in texts] + [(1, None)], "removed_spans long, text string")
    rows = with_nested_spans(frame, 40, 16, 20, 8, max_group).collect()
    assert len(rows) == len(texts) + 1
    got = {r.text: r for r in rows}
    for length, column in ((40, "removed_spans"), (20, "passage_spans")):
        for text, mark in zip(texts, covered([t.encode() for t in texts], length)):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mark.astype(int), [0])))).reshape(-1, 2).tolist()
            assert [[s["start"], s["stop"]] for s in got[text][column] or ()] == edges, text


def test_nested_spans_of_odd_rows(odd_docs, no_docs):
    out = with_nested_spans(odd_docs)
    assert out.columns == [c for c in odd_docs.columns if c != "removed_spans"] + ["passage_spans", "removed_spans"]
    alone = {(r.doc_id, r.text): r.removed_spans for r in with_spans(odd_docs).collect()}
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(alone[r.doc_id, r.text] == r.removed_spans for r in rows)
    assert with_nested_spans(no_docs).count() == 0


def test_odd_rows(odd_docs, no_docs):
    out = drop_repeats(odd_docs)
    assert out.columns == odd_docs.columns
    left = {(r.doc_id, r.text, r.n_chars) for r in out.collect()}
    assert (3, None, None) in left and (4, "", 0) in left
    # all of 6 stands in 7 as well; only the end of 7 is its own
    assert not [x for x in left if x[0] == 6] and (7, " tail", 5) in left
    assert out.count() == odd_docs.count() - 1
    assert drop_repeats(no_docs).count() == 0


def test_keep_bytes():
    assert keep_bytes(b"abcdef", [{"start": 1, "stop": 3}, {"start": 5, "stop": 6}]) == b"ade"
    assert keep_bytes(b"abc", None) == b"abc"
