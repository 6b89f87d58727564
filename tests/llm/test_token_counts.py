from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from regiontally.llm.token_counts import PATTERN, TOKENIZER, attribute, encoder, lay_out, token_counts
from tests.conftest import SF0001


@pytest.mark.parametrize("rule", ["first", "most", "share"])
def test_matches_a_walk_over_bytes(spark, rule):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").limit(60)
    rows = {r.doc_id: r for r in docs.collect()}
    got = defaultdict(dict)
    for r in token_counts(docs, rule=rule).collect():
        got[r.doc_id][r.section] = r.n_tokens
    encoding, _ = encoder(TOKENIZER, PATTERN)
    for i, r in rows.items():
        text, sections = lay_out([r.source, r.lang, r.text], ("source", "lang", "text"))
        owner = [k for k, (_, n) in enumerate(sections) for _ in range(n)]
        assert len(owner) == len(text.encode())
        expected, at = defaultdict(float), 0
        for token in encoding.encode_ordinary(text):
            n = len(encoding.decode_single_token_bytes(token))
            own = owner[at : at + n]
            at += n
            if rule == "first":
                expected[own[0]] += 1
            elif rule == "most":
                expected[max(sorted(set(own)), key=own.count)] += 1
            else:
                for k in own:
                    expected[k] += 1 / n
        assert {k: v for k, v in got[i].items() if v} == pytest.approx(dict(expected))


def test_attribute_rules_at_a_boundary():
    ends, bounds = np.array([3, 9, 10]), np.array([0, 4, 6, 10])
    assert attribute(ends, bounds, "first").tolist() == [2, 0, 1]
    assert attribute(ends, bounds, "most").tolist() == [1, 0, 2]
    assert attribute(ends, bounds, "share") == pytest.approx([1 + 1 / 6, 2 / 6, 1 + 3 / 6])


def test_odd_rows(odd_docs, no_docs):
    got = token_counts(odd_docs).collect()
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert 3 not in by_id  # every field null
    assert [r.field for r in by_id[4]] == ["source", "lang"]
    assert sum(r.n_tokens for r in by_id[6]) == by_id[6][0].doc_tokens
    assert token_counts(no_docs).count() == 0
    with pytest.raises(ValueError):
        token_counts(odd_docs, rule="other")
