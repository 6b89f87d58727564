from __future__ import annotations

import re
from collections import Counter

from regiontally.llm.quality_rules import bad_line, op5_quality_rules, quality_rules
from tests.conftest import SF001

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    words, seen, repeated = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def test_counts_match_brute_force_and_clean_documents_stay(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    rows = op5_quality_rules(spark, SF001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(docs[r.doc_id])
        assert not (r.base_failed and r.kept)
        if labels.get(r.doc_id) == 1 and not r.base_failed:
            assert r.kept, docs[r.doc_id]
        if labels.get(r.doc_id) == 0:
            assert not r.kept


def test_line_rules():
    assert bad_line(b"Home | About | Contact | Help | More", 9) == "punctuation"
    assert bad_line(b"Home. | About | Contact | Help | More", 9) == "navigation"
    assert bad_line(b"BUY!! NOW!! CHEAP!!", 3) == "punctuation"
    assert bad_line(b"Read our privacy policy here.", 5) == "boilerplate"
    assert bad_line(b"A plain sentence ends here.", 5) is None


def test_sentence_marks_of_other_scripts():
    for line in ("यह एक सरल वाक्य है।", "هل هذه جملة بسيطة؟", "یہ ایک سادہ جملہ ہے۔", "Սա պարզ նախադասություն է։", "これは 簡単な 文 です。", "ይህ ቀላል ዓረፍተ ነገር ነው።"):
        assert bad_line(line.encode(), len(line.split())) is None, line
    assert bad_line("यह एक सरल वाक्य है".encode(), 5) == "punctuation"


def test_odd_rows(odd_docs, no_docs):
    got = {r.doc_id: r for r in quality_rules(odd_docs).collect()}
    assert got[3].n_words == 0 and got[3].base_failed and not got[3].kept and got[3].clean_text == ""
    assert got[6].kept is False  # one line of words without any sentence mark
    assert quality_rules(no_docs).count() == 0


def test_phrases_in_clean_text_cost_no_line(spark):
    for phrase in ("design in", "catalog in", "blog in", "JavaScript", "privacy policy", "d\u00e9sign in"):
        line = f"The workshop spent a long week on {phrase} small teams before anyone wrote a page of the report.".encode()
        assert bad_line(line, len(line.split())) is None, phrase
    assert bad_line(b"The best design in years.", 5) is None
    assert bad_line(b"Sign in or log in.", 5) == "boilerplate"
    text = "Our group compared JavaScript with older tools, and found that careful design in early stages saves many weeks of later work."
    (row,) = quality_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.kept and row.clean_text == text
