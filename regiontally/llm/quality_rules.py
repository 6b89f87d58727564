"""Quality rules, line first.

Every line with a word is judged by itself: punctuation (no sentence mark at
all in a line of several words, or a mark of emphasis on half of its words),
navigation (a run of separated entries, or too many symbols) and boilerplate
(known phrases that make up a fifth of
its words, or a repeat of an earlier line). Failed lines are removed; a
document whose different lines lose more than half of their characters in
words is rejected (a repeated line is removed, but is no loss).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm.common import as_bytes, batch_columns, chunks, ngram_hashes, table, word_hashes

SYMBOLS = b"#*$%&|<>"
MAX_LOST = 0.5
BOILERPLATE_SHARE = 0.2  # of a line's words in known phrases
BOILERPLATE = re.compile(
    rb"(?i)(?<![\w\x80-\xff])(?:lorem ipsum|javascript|cookie (?:policy|settings)|privacy policy|terms of (?:use|service)|all rights reserved|"
    rb"click here|sign in|log in|subscribe to our|page not found|skip to content)(?![\w\x80-\xff])"
)
# Sentence marks: those of Unicode's Sentence_Terminal in common scripts (Arabic, Devanagari, Armenian, Ethiopic,
# Khmer, Burmese, Tibetan, CJK, full width) and the ellipsis.
_MARKS = re.compile("|".join(re.escape(m) for m in ".!?…‼⁇⁈⁉؟۔܂।॥։።፧፨។៕၊။།༎。！？．｡؛‽").encode())
_SPACES = b" \t\n\x0b\x0c\r"


def word_chars(text: bytes) -> int:
    """Code points outside ASCII white space."""
    return len(text.translate(None, _SPACES).decode("utf-8", "replace"))


def bad_line(line: bytes, n_words: int) -> str | None:
    """The rule that a line fails, or None."""
    if n_words >= 3 and not _MARKS.search(line):
        return "punctuation"
    if n_words >= 2 and 2 * line.count(b"!") >= n_words:
        return "punctuation"
    if n_words >= 4 and 4 * (line.count(b" | ") + line.count(" · ".encode()) + line.count(" • ".encode())) >= n_words:
        return "navigation"
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    if symbols >= 3 and 10 * symbols >= len(line):
        return "navigation"
    if sum(len(x.split()) for x in BOILERPLATE.findall(line)) >= max(1, BOILERPLATE_SHARE * n_words):
        return "boilerplate"
    return None


def clean_lines(text: bytes) -> tuple[bytes, int, int, int]:
    """The text of the lines that pass, its characters in words and those of all different lines, and the number of repeated lines."""
    kept, seen, repeated = [], {}, 0
    for line in text.split(b"\n"):
        n = len(line.split())
        if not n:
            continue
        if line in seen:
            repeated += 1
            continue
        seen[line] = True
        if bad_line(line, n) is None:
            kept.append(line)
    out = b"\n".join(kept)
    return out, word_chars(out), word_chars(b"".join(seen)), repeated


def repeat_words(hashes: np.ndarray, n: int = 5) -> int:
    """Words inside windows of ``n`` words that occur twice or more."""
    grams = ngram_hashes(hashes, n)
    if not len(grams):
        return 0
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    if not same.any():
        return 0
    many = np.zeros(len(grams), dtype=bool)
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    at = np.flatnonzero(many)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + n, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, kept_chars long, clean_text string"
)


def _judge(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch_columns(batch, "doc_id", "text")
            for first, held in chunks(texts):
                rows = []
                for i, text in enumerate(held, first):
                    hashes = word_hashes(np.frombuffer(text, dtype=np.uint8))[2]
                    n, chars = len(hashes), word_chars(text)
                    repeated_words = repeat_words(hashes)
                    clean, kept_chars, whole, repeated = clean_lines(text)
                    failed = n < 10 or 100 * repeated_words > 20 * n
                    kept = not failed and kept_chars >= (1 - MAX_LOST) * whole
                    symbols = len(text) - len(text.translate(None, SYMBOLS))
                    rows.append((ids[i], n, chars, symbols, repeated, repeated_words, failed, kept, kept_chars, clean.decode("utf-8", "replace") if with_text else None))
                names = [c.split()[0] for c in _SCHEMA.split(", ")]
                types = [pa.int64()] * 6 + [pa.bool_(), pa.bool_(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def quality_rules(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Counts, base verdict, line verdict and (``with_text``) the cleaned text of every row.

    Reads ``doc_id`` and ``text`` and ignores other columns. A null text is
    empty: no words, so the base check fails. Repeated rows are judged alike;
    an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text"))
    return docs.mapInArrow(_judge(with_text), _SCHEMA)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), with_text=False).drop("clean_text")
