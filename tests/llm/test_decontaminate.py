from __future__ import annotations

import random

import numpy as np
import pytest

from regiontally.llm.decontaminate import MATCH, align, drop_leaks, find_leaks, normalise, op9_decontaminate
from tests.conftest import SF001


def smith_waterman(a, b):
    """Textbook recurrence."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_matches_the_recurrence():
    rng = np.random.RandomState(1)
    for _ in range(60):
        a, b = (rng.randint(0, 5, rng.randint(1, 30)).astype(np.uint64) for _ in range(2))
        assert align(a, b)[0] == smith_waterman(a.tolist(), b.tolist())


def test_edited_copies_are_found_and_fragments_left_alone(spark):
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(40))) for i in range(20)] + [(90, "tiny item"), (91, None), (92, "")]
    rows, leaked = [], set()
    for d in range(200):
        words = [rng.choice(vocabulary) for _ in range(200)]
        item = items[d % 20][1].split()
        if d % 4 == 0:  # an edited copy: every eighth word replaced, one left out, upper case and marks
            copy = [rng.choice(vocabulary) if k % 8 == 3 else w.upper() + "," for k, w in enumerate(item) if k != 5]
            words[50:50] = copy
            leaked.add((d, d % 20))
        elif d % 4 == 1:
            words[50:50] = item[:6]
        rows.append((str(d), " ".join(words)))
    docs = spark.createDataFrame(rows + [(None, items[0][1]), ("500", None), ("501", "a tiny item here")], "key string, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 20, 1500):  # one block, and several
        got = {(int(r.key), r.item_id) for r in find_leaks(docs, benchmark, block_bytes=size).collect()}
        assert got == leaked | {(501, 90)}


def test_a_leak_copied_everywhere_keeps_its_seeds(spark):
    item = " ".join(f"u{i}" for i in range(30))
    docs = spark.createDataFrame([(str(i), f"start{i} {item} end{i}") for i in range(600)], "key string, text string")
    assert find_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).count() == 600


def test_query_finds_every_whole_item(spark):
    docs = {r.doc_id: normalise(r.text).split() for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    items = {r.item_id: normalise(r.text).split() for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()}
    whole = {(d, i) for d, w in docs.items() for i, x in items.items() if b" " + b" ".join(x) + b" " in b" " + b" ".join(w) + b" "}
    rows = op9_decontaminate(spark, SF001).collect()
    assert whole <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        assert smith_waterman(docs[r.doc_id][r.word_start : r.word_end], items[r.item_id]) == pytest.approx(r.score * MATCH * len(items[r.item_id]))


def test_odd_rows(spark, odd_docs, no_docs):
    text = odd_docs.filter("doc_id = 2").first().text
    benchmark = spark.createDataFrame([(1, text), (1, "another item"), (None, text)], "item_id long, text string")
    out = drop_leaks(odd_docs, benchmark)
    assert out.columns == odd_docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4, 5, 6, 7, 8]
    assert drop_leaks(no_docs, benchmark).count() == 0
    assert drop_leaks(odd_docs, benchmark.filter("1 = 0")).count() == odd_docs.count()


def test_one_edited_version_copied_more_than_the_item_is_found(spark):
    rng = random.Random(4)
    item = [f"i{k}" for k in range(40)]
    edited = " ".join(f"other{k}" if k % 5 == 4 else w for k, w in enumerate(item))
    # more copies than 10 times the item's usual count of 1, plus 100
    rows = [("0", " ".join(item))] + [(str(d), f"a{d} {edited} b{rng.randrange(9)}") for d in range(1, 400)]
    got = find_leaks(spark.createDataFrame(rows, "key string, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert {int(r.key): r.score > 0.6 for r in got.collect()} == dict.fromkeys(range(400), True)


def test_every_pair_at_the_score_is_found(spark):
    rng = random.Random(6)
    vocabulary = [f"word{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((3, 5, 15, 40))))) for i in range(24)]

    def edited(words, kind):
        out = []
        for k, w in enumerate(words):
            if kind == "insert":  # a foreign word after each word
                out += [w, rng.choice(vocabulary)]
            elif kind == "random":
                r = rng.random()
                out += [] if r < 0.1 else [rng.choice(vocabulary)] if r < 0.3 else [w, rng.choice(vocabulary)] if r < 0.4 else [w]
            else:  # every third, fourth or fifth word replaced
                out.append(rng.choice(vocabulary) if k % kind == kind - 1 else w)
        return out

    docs = []
    for d, kind in enumerate((3, 4, 5, "insert", "random", "random") * 24):
        words = [rng.choice(vocabulary) for _ in range(60)]
        words[20:20] = edited(items[d // 6][1].split(), kind)
        docs.append((str(d), " ".join(words)))
    expected = {
        (int(d), i) for d, t in docs for i, x in items if smith_waterman(t.split(), x.split()) >= 0.5 * MATCH * len(x.split())
    }
    assert len(expected) > 100
    rows = find_leaks(spark.createDataFrame(docs, "key string, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(int(r.key), r.item_id) for r in rows.collect()} == expected
