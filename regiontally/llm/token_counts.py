"""Token counts per section, by offset-mapped attribution.

A document's fields are laid out one after the other and encoded once, as a
whole, so tokens are those a model would see. Every token's span of bytes
follows from the lengths of the tokens; spans are joined with the intervals of
the sections (each field, and each line of the text field), and a token that
crosses a boundary is allocated by a stated rule:

* ``first``: to the section of its first byte,
* ``most``: to the section that holds most of its bytes, the earlier on a tie,
* ``share``: to every section it touches, by its share of the bytes.

Bytes and code points give the same sections, since sections begin and end at
whole code points, and a token may be a part of one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm.common import batch_columns, table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FIELDS = ("source", "lang", "text")
RULE = "most"
RULES = ("first", "most", "share")
PIECE_BYTES = 1 << 16


@cache
def encoder(path: str, pattern: str):
    """The encoding of a vocabulary file, and the byte length of each token; loaded once per process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def lay_out(values: list[str | None], fields: tuple[str, ...]) -> tuple[str, list[tuple[str, int]]]:
    """The document of the fields' values, and its sections (field, bytes), which cover it.

    Fields end in a newline, which belongs to them; a last field's lines end in
    their own newlines. A null field is empty and has no section.
    """
    parts, sections = [], []
    for k, (name, value) in enumerate(zip(fields, values)):
        if value is None:
            continue
        if k < len(fields) - 1:
            parts.append(f"{value}\n")
            sections.append((name, len(parts[-1].encode())))
        else:
            for line in value.split("\n"):
                sections.append((name, len(line.encode()) + 1))
            if value:
                sections[-1] = (name, sections[-1][1] - 1)
            else:
                sections.pop()
            parts.append(value)
    return "".join(parts), sections


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section: ``ends`` are the tokens' end bytes, ``bounds`` the sections' (from 0)."""
    n = len(bounds) - 1
    starts = np.concatenate(([0], ends[:-1]))
    first = np.minimum(np.searchsorted(bounds, starts, side="right") - 1, n - 1)
    last = np.minimum(np.searchsorted(bounds, ends, side="left") - 1, n - 1)
    last = np.maximum(last, first)
    out = np.bincount(first[first == last], minlength=n).astype(float)
    if rule == "first":
        return np.bincount(first, minlength=n).astype(float)
    for k in np.flatnonzero(first != last).tolist():
        touched = np.arange(first[k], last[k] + 1)
        part = np.minimum(bounds[touched + 1], ends[k]) - np.maximum(bounds[touched], starts[k])
        if rule == "most":
            out[touched[int(part.argmax())]] += 1
        else:
            out[touched] += part / part.sum()
    return out


def _count(path: str, pattern: str, fields: tuple[str, ...], rule: str):
    names = ["doc_id", "section", "field", "n_bytes", "n_tokens", "doc_tokens"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.float64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = encoder(path, pattern)
        for batch in batches:
            ids, *columns = batch_columns(batch, "doc_id", *fields)
            rows, held = [], 0
            for i, *values in zip(ids, *columns):
                text, sections = lay_out(values, fields)
                if not sections:
                    continue
                sizes = np.array([n for _, n in sections], dtype=np.int64)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                tokens = np.array(encoding.encode_ordinary(text), dtype=np.int64)
                found = attribute(np.cumsum(lengths[tokens]), bounds, rule)
                rows.extend(zip([i] * len(sizes), range(len(sizes)), [f for f, _ in sections], sizes.tolist(), found.tolist(), [len(tokens)] * len(sizes)))
                held += len(text)
                if held > PIECE_BYTES * 16:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def token_counts(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, rule: str = RULE, path: str = TOKENIZER, pattern: str = PATTERN
) -> DataFrame:
    """(doc_id, section, field, n_bytes, n_tokens, doc_tokens): a row per section of each row of ``docs``.

    ``path`` is a vocabulary file (base64 token and rank a line) that every
    executor can read, ``pattern`` its split pattern. Sections of a document
    sum to ``doc_tokens``. A null field has no section and an empty one holds
    its newline only; a row of null fields has no sections; repeated rows are
    counted alike; columns that are not named are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    columns = [F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f).cast("string").alias(f) for f in fields]]
    return docs.select(*columns).mapInArrow(
        _count(path, pattern, tuple(fields), rule), "doc_id long, section int, field string, n_bytes long, n_tokens double, doc_tokens long"
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
