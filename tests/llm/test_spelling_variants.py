"""Spelling variants against an edit-distance check of all pairs."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from regiontally.llm import spelling_variants as sv
from tests.conftest import SF0001


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    near = {w: [v for v in counts if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), None if form[w] is None else counts[form[w]]) for w, n in counts.items()}


def rows_of(df):
    assert df.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r)[:6] for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_counts(seed, size=1500, letters="abcdé"):
    rng = random.Random(seed)
    words = set()
    while len(words) < size:
        word = "".join(rng.choice(letters) for _ in range(rng.choice([6, 6, 7, 7, 8, 9])))
        words.add(word)
        at = rng.randrange(len(word))
        words.add(word[:at] + rng.choice(letters) + word[at + rng.choice([0, 1]) :])
    return {w: rng.choice([5, 5, 6, 30, 31, 200, 1000, 6000]) for w in words if len(w) >= 6}


@pytest.mark.parametrize("cell_words", [20, 300, 20_000])
def test_forms_match_all_pairs_for_any_cell_size(spark, cell_words):
    counts = random_counts(cell_words)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert rows_of(sv.spelling_forms(df, cell_words=cell_words)) == brute(counts)


def contract_counts(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in sv.RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    counts = contract_counts(docs)
    assert len(counts) > 300
    assert rows_of(sv.op12_spelling_variants(spark, SF0001)) == brute(counts)


def test_odd_input(spark, odd_docs, no_docs):
    found = rows_of(sv.spelling_forms(sv.word_counts(odd_docs, min_count=1)))
    assert {"quick", "the"}.isdisjoint({w for w, *_ in found}) and "wizards" in {w for w, *_ in found}
    assert sv.spelling_forms(sv.word_counts(no_docs)).isEmpty()
    long = "x" * 80_000
    docs = spark.createDataFrame([(None, long), (1, long[:-1] + "y"), (2, "ÀÖ×÷ÿß " * 5), (3, None)], "doc_id long, text string")
    got = {w: near for w, _, _, _, near, _ in rows_of(sv.spelling_forms(sv.word_counts(docs, min_count=1)))}
    assert got[long] == 1 and got["ÀÖ×÷ÿß"] == 0  # upper case outside A-Z stays


def test_chains_of_forms_are_followed(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625, "zzzzzzz": 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows_of(sv.spelling_forms(df))
    assert got == brute(words)
    assert {r[2] for r in got} == {"abbbbb", "zzzzzzz"}


def test_large_sets_of_anagrams_are_joined_by_key():
    rng = random.Random(4)
    first = list({"".join(rng.sample("abcdefgh", 8)) for _ in range(3000)})
    second = [w.replace("h", "z") for w in first[::2]]
    got = set(sv.near_words(first, second, False))
    assert got == {(w, w.replace("h", "z")) for w in first[::2]}


def test_coarse_cells_cover_every_point_and_box():
    rng = np.random.RandomState(3)
    points = rng.randint(0, 4, size=(500, 6)).astype(np.int32)
    tree = sv.CoarseTree(points[:200], 12)
    home = {}
    for cell, rows in tree.reached(points, 0):
        for row in rows:
            assert home.setdefault(int(row), cell) == cell
    assert len(home) == 500 and tree.cells > 6
    for radius in (1, 2):
        seen = {(int(row), cell) for cell, rows in tree.reached(points, radius) for row in rows}
        near = np.abs(points[:, None] - points[None]).sum(axis=2) <= radius
        assert {(i, home[j]) for i, j in zip(*np.nonzero(near))} <= seen
