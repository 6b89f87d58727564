"""The prefix trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from regiontally.llm.prefix_trie import (
    TernaryTree,
    conversation_trie,
    distinct_paths,
    median_order,
    op11_prefix_trie,
    paths,
    prefix_trie,
    rebuilt,
    turns_in_order,
)
from tests.conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in by_conv.items()}


def rebuild(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = seqs.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    rows = []
    for node, convs in members.items():
        under = [p for p in members if p[: len(node)] == node]
        parents = {p[:-1] for p in members if p}
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in under if p)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(seqs[c]) == len(node)))
        rows.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(p) == len(node) + 1 for p in under), sum(p not in parents for p in under), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def collected(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    says = ["", "a", "a b", "b  a\tc", "é 中 x"]
    rows = []
    for c in range(n):
        for turn in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(says[: rng.choice([1, 2, 5])])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_paths", [1, 3, 50_000])
def test_matches_brute_force_for_any_shard_size(spark, shard_paths):
    rows = random_rows(shard_paths)
    turns = turns_in_order(spark.createDataFrame(rows, SCHEMA))
    seqs = paths(rebuilt(turns), turns.select("conv_id").distinct())
    assert collected(prefix_trie(seqs, shard_paths)) == brute(rebuild(sequences(rows)))


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(op11_prefix_trie(spark, SF001)) == brute(rebuild(sequences(rows)))


def test_nulls_ties_copies_and_turnless_conversations(spark):
    rows = [
        (None, 0, "user", "lost"),
        (1, None, "user", "first"),
        (1, 0, None, "second"),
        (1, 0, "a", None),
        (1, 0, "a", None),
        (2, 5, "user", "only"),
        (42, 0, "user", "x"),
        *[(100 + i, 0, "user", "same") for i in range(30)],
    ]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", digest string, path int")
    seqs = sequences(rows)
    assert collected(conversation_trie(frame)) == brute(seqs)
    turns = turns_in_order(frame)
    got = collected(prefix_trie(paths(rebuilt(turns), turns.select("conv_id").distinct())))
    again = rebuild(seqs)
    assert any(not s for s in again.values()) and got == brute(again)


def test_empty_table(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_a_very_long_conversation(spark):
    rows = [(c, i, "user", f"t {i}") for c in (1, 2) for i in range(3000)] + [(3, i, "user", f"t {i}") for i in range(1500)]
    got = {(r.conv_id, r.depth): r for r in conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 3001
    root = got[(1, 0)]
    assert (root.n_convs, root.n_children, root.n_leaves, root.saved_tokens) == (3, 1, 1, 2 * (2 * 1500 + 1500))


def test_copies_keep_all_their_ids_in_order(spark, monkeypatch):
    rows = [(c, 0, "user", "same") for c in range(999, -1, -1)]
    turns = turns_in_order(spark.createDataFrame(rows, SCHEMA))
    (row,) = distinct_paths(paths(turns, turns.select("conv_id").distinct())).collect()
    assert (row.conv_id, row.n_convs) == (0, 1000)
    assert row.ends == hashlib.sha256(",".join(map(str, range(1000))).encode()).hexdigest()


def test_median_insertion_balances_the_tree():
    assert sorted(median_order(100)) == list(range(100)) and median_order(0) == []
    tree = TernaryTree()
    for i in median_order(1023):
        tree.insert([i])

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.lo[node]), height(tree.hi[node]))

    assert height(tree.eq[0]) == 10
