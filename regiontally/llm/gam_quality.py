"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a handful of shape features. Features are cut into quantile
bins; cyclic boosting fits one shallow regression tree at a time to each
feature in turn and adds it to that feature's lookup table, then does the same
for the pairs of features whose residuals interact most. A score is the
logistic function of a sum of table look-ups, so scoring is vectorised binning
and addition.

Tables are learned on a bounded sample of labelled rows (``SAMPLE_ROWS``, the
ones with the smallest hashes); scoring covers every row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm.common import as_bytes, batch_columns, chunks, cut, table, word_hashes

SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
RATE = 0.1
THRESHOLD = 0.3

FEATURES = (
    "log_words",
    "word_length",
    "upper",
    "symbols",
    "bars",
    "exclamations",
    "digits",
    "sentence_marks",
    "commas",
    "non_ascii",
    "line_words",
    "repeated_next",
    "distinct_words",
    "repeated_lines",
)

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "symbols": b"#*$%&<>@^~=_\\{}[]",
    "bars": b"|",
    "exclamations": b"!",
    "digits": b"0123456789",
    "sentence_marks": b".?",
    "commas": b",;:",
    "non_ascii": bytes(range(0xC0, 0x100)),
    "lines": b"\n",
}
_FLAGS = {name: np.isin(np.arange(256), np.frombuffer(chars, dtype=np.uint8)).astype(np.int64) for name, chars in _CLASSES.items()}


def features(texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text; a text without words is all zeros but for its counts."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        data = np.frombuffer(text, dtype=np.uint8)
        if not len(data):
            continue
        counts = np.bincount(data, minlength=256)
        n = {name: int((counts * flags).sum()) for name, flags in _FLAGS.items()}
        starts, ends, words = word_hashes(data)
        m = max(1, len(words))
        chars = max(1, int((ends - starts).sum()))
        lines = [x for x in text.split(b"\n") if x.strip()]
        out[i] = (
            np.log1p(len(words)),
            min(chars / m, 40.0),
            n["upper"] / chars,
            n["symbols"] / chars,
            n["bars"] / m,
            n["exclamations"] / m,
            n["digits"] / chars,
            n["sentence_marks"] / m,
            n["commas"] / m,
            n["non_ascii"] / chars,
            np.log1p(m / (n["lines"] + 1)),
            (words[1:] == words[:-1]).sum() / m,
            len(np.unique(words)) / m,
            1 - len(set(lines)) / max(1, len(lines)),
        )
    return out


@dataclass
class GamModel:
    """Bin edges, a table per feature, and a table per pair."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), values in zip(self.pairs, self.pair_tables):
            total += values[
                np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")
            ]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _quantiles(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 3, least: float = 2.0) -> np.ndarray:
    """Greedy regression tree over ordered bins: the Newton step of each bin."""
    cuts = [0, len(gradient)]
    g, w = np.concatenate(([0], np.cumsum(gradient))), np.concatenate(([0], np.cumsum(weight)))

    def gain(a, b):
        return (g[b] - g[a]) ** 2 / (w[b] - w[a] + 1.0)

    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = np.arange(a + 1, b)
            if len(at):
                found = np.where((w[at] - w[a] >= least) & (w[b] - w[at] >= least), gain(a, at) + gain(at, b) - gain(a, b), -1)
                k = int(np.argmax(found))
                if found[k] > best[0]:
                    best = (found[k], int(at[k]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(gradient))
    for a, b in zip(cuts[:-1], cuts[1:]):
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + 1.0)
    return out


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One cut of the first feature, then a cut of the second on each side."""
    best, out = -1.0, np.zeros_like(gradient)
    for at in range(1, gradient.shape[0]):
        trial, total = np.zeros_like(gradient), 0.0
        for part in (slice(0, at), slice(at, None)):
            steps = _tree(gradient[part].sum(0), weight[part].sum(0), leaves=2)
            trial[part] = steps
            total += float((steps * gradient[part].sum(0)).sum())
        if total > best:
            best, out = total, trial
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, n_pairs: int = PAIRS) -> GamModel:
    """Cyclic boosting of single-feature tables, then of the strongest pairs."""
    model = GamModel()
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        model.intercept = float(np.log(share / (1 - share)))
        return model
    model.intercept = float(np.log(y.mean() / (1 - y.mean())))
    model.edges = [_quantiles(x[:, j], BINS) for j in range(x.shape[1])]
    model.coarse = [_quantiles(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)

    def residual():
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, b in enumerate(bins):
            g, w = residual()
            size = len(model.tables[j])
            step = rate * _tree(np.bincount(b, g, size), np.bincount(b, w, size))
            model.tables[j] += step
            total += step[b]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]

    def grids(a, b, g, w):
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        return cell, np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, w, shape[0] * shape[1]).reshape(shape)

    g, w = residual()
    strength = []
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            _, gg, ww = grids(a, b, g, w)
            strength.append((float((_pair_tree(gg, ww) * gg).sum()), a, b))
    model.pairs = [(a, b) for _, a, b in sorted(strength, reverse=True)[:n_pairs]]
    model.pair_tables = [np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(rounds // 4):
        for k, (a, b) in enumerate(model.pairs):
            g, w = residual()
            cell, gg, ww = grids(a, b, g, w)
            step = rate * _pair_tree(gg, ww)
            model.pair_tables[k] += step
            total += step.ravel()[cell]
    return model


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch_columns(batch, "doc_id", "text")
        for first, held in chunks(texts):
            found = features(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[first : first + len(held)], pa.int64()),
                    pa.ListArray.from_arrays(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32), found.ravel()),
                ],
                names=["doc_id", "x"],
            )


def text_features(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text"))
    return docs.mapInArrow(_featurise, "doc_id long, x array<double>")


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's text, modulo 5; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def labelled_sample(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, quality) of the ``sample_rows`` labelled rows of the smallest hashes, outside the held-out fold.

    Null labels and ids are left out; a document labelled twice counts twice.
    """
    known = labels.filter("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    known = known.filter(fold_of(F.col("doc_id")) != 0)
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # a first cut by hash leaves about twice the sample, so that the ordering handles little
    share = 2 * sample_rows / max(1, known.count())
    if share < 1:
        known = known.filter(spread < int(share * (1 << 30)))
    return cut(known.orderBy(spread, "doc_id", "quality").limit(sample_rows))


def train(found: DataFrame, sample: DataFrame) -> GamModel:
    """Fit on the features ``found`` of the rows of ``sample`` (see ``labelled_sample``)."""
    # SAMPLE_ROWS rows of 14 numbers at most come to the driver, also where a doc_id repeats: those of the smallest hashes
    joined = found.join(F.broadcast(sample), "doc_id").select("doc_id", "x", "quality")
    rows = joined.orderBy(F.xxhash64("doc_id", "x"), "doc_id", "x", "quality").limit(SAMPLE_ROWS).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"], r["quality"]))
    x = np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([float(r["quality"] > 0) for r in rows]))


def _apply(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("x"))
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(model.value.score(x))], names=["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Only ``doc_id`` and ``text`` are read; a score depends on the text alone. A
    null text scores as an empty one. Without labels every score is 0.5.
    """
    found = cut(text_features(docs))
    model = docs.sparkSession.sparkContext.broadcast(train(found, labelled_sample(labels)))
    scored = found.mapInArrow(_apply(model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _keep(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            keep = np.zeros(len(texts), dtype=bool)
            for first, held in chunks(texts):
                keep[first : first + len(held)] = model.value.score(features(held)) >= threshold
            yield batch.filter(pa.array(keep))

    return run


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    sample = labelled_sample(labels)
    # SAMPLE_ROWS ids at most: a bounded broadcast, so that no text is shuffled
    chosen = docs.join(F.broadcast(sample.select(F.col("doc_id").alias("__id")).distinct()), F.col("doc_id").cast("long") == F.col("__id"), "left_semi")
    model = train(text_features(chosen), sample)
    return docs.mapInArrow(_keep(docs.sparkSession.sparkContext.broadcast(model), threshold), docs.schema)


def crc_fold(doc_id: int) -> int:
    """The fold in plain Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 5


def op4_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
