"""Cross-entropy difference of a target and a background n-gram model.

Both models are bigram models over all words of the corpus, with the same
smoothing: a bigram estimate mixed with an add-one unigram estimate. The
background model counts every document, the target model the documents picked
as target. Neither model knows the text that it scores: a document's own counts
are left out of the background, and of the target model if it is a target
(otherwise targets would be scored by their own training rows). Every word and every bigram has a count of its own, by a 64-bit
hash, so the tables grow with the corpus and stay in Spark: documents are cut
into blocks, the different words and bigrams of a block go to the groups of
their hashes with their counts in the block, and the sums over all blocks come
back to each block in the order of its own hashes.

A document's score is the mean over its tokens of target loss less background
loss, in nats: the lower, the more it reads like the target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm.common import as_bytes, batch_columns, chunks, cut, ngram_hashes, release, table, word_hashes

BIGRAM_WEIGHT = 0.7
BLOCK_BYTES = 16 << 20  # text of a block of documents
GROUP_BYTES = 64 << 20  # text of the corpus per group of hashes
OWN_TOKENS = 1 << 18
LEAST_BITS = 8
BROADCAST_BYTES = 64 << 20


def _chunk_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a chunk of texts in lower case, and each text's bounds."""
    held = [t.lower() for t in texts]
    data = np.frombuffer(b"\n".join(held), dtype=np.uint8)
    starts, _, words = word_hashes(data)
    ends = np.cumsum(np.fromiter(map(len, held), dtype=np.int64, count=len(held)) + 1)
    return words, np.searchsorted(starts, np.concatenate(([0], ends)))


def _inner(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which pairs of neighbours lie in one text."""
    same = np.ones(max(0, len(ids) - 1), dtype=bool)
    cuts = bounds[1:-1]
    same[cuts[(cuts > 0) & (cuts < len(ids))] - 1] = False
    return same


class _Grams:
    """Hashes of the words and bigrams of the texts of a block, as they come."""

    def __init__(self):
        self.words, self.pairs, self.lengths, self.inner = [], [], [], []

    def add(self, texts: list[bytes]) -> None:
        words, bounds = _chunk_words(texts)
        inner = _inner(words, bounds)
        self.words.append(words)
        self.pairs.append(ngram_hashes(words, 2)[inner])
        self.lengths.append(np.diff(bounds))
        # no pair joins the last word of a chunk to the first of the next
        self.inner.append(np.concatenate((inner, np.zeros(min(1, len(words)), dtype=bool))))


def _pack(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes each; the first byte says how many."""
    kind = np.min_scalar_type(int(counts.max()))
    return bytes([kind.itemsize]) + counts.astype(kind).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


def _pack_hashes(known: np.ndarray) -> bytes:
    """Sorted hashes by the bytes of their differences, which leaves runs of zeros to the compression of the shuffle."""
    steps = np.diff(known, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack_hashes(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


#: A block of documents is one row, so it is whole in every read.
_BLOCKS = "block long, doc_ids array<long>, target array<boolean>, sizes array<long>, text binary"
_COUNTS = "block long, bucket int, kind int, grams binary, n binary, t binary"


def _pack_block(block: int, keys: list, chosen: list, texts: list[bytes]) -> pa.RecordBatch:
    data = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
    columns = [[block], [keys], [chosen], [list(map(len, texts))], [data]]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "doc_ids", "target", "sizes", "text"])


def _block_grams(sizes: list[int], data: bytes) -> _Grams:
    grams, ends = _Grams(), np.cumsum([0, *sizes]).tolist()
    text = pa.decompress(data, decompressed_size=ends[-1], codec="zstd", asbytes=True)
    for _, held in chunks(text[a:b] for a, b in zip(ends, ends[1:])):
        grams.add(held)
    return grams


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, size = TaskContext.get().partitionId() << 32, 0
    held: tuple[list, list, list] = ([], [], [])
    for batch in batches:
        for row in zip(*batch_columns(batch, "doc_id", "target", "text")):
            for column, x in zip(held, (*row[:2], row[2] or b"")):
                column.append(x)
            size += len(held[2][-1])
            if size >= BLOCK_BYTES:
                yield _pack_block(block, *held)
                block, size, held = block + 1, 0, ([], [], [])
    if held[0]:
        yield _pack_block(block, *held)


def _count_blocks(bits: int):
    """The different words (kind 1) and bigrams (kind 2) of each block by bucket: sorted hashes, and counts in all and in targets."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, chosen, sizes, data in zip(*batch_columns(batch, "block", "target", "sizes", "text")):
                grams = _block_grams(sizes, data)
                lengths, wanted = np.concatenate(grams.lengths), np.array(chosen, dtype=bool)
                for kind, hashes, each in ((1, grams.words, lengths), (2, grams.pairs, np.maximum(lengths - 1, 0))):
                    known, place = np.unique(np.concatenate(hashes), return_inverse=True)
                    n = np.bincount(place, minlength=len(known))
                    t = np.bincount(place[np.repeat(wanted, each)], minlength=len(known))
                    bucket = (known >> np.uint64(64 - bits)).astype(np.int64)
                    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                    rows = []
                    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(known)]):
                        rows.append((block, int(bucket[a]), kind, _pack_hashes(known[a:b]), _pack(n[a:b]), _pack(t[a:b])))
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["block", "bucket", "kind", "grams", "n", "t"]
                        )

    return run


_SUMS = "block long, bucket int, kind int, n binary, t binary, known long, said long, wanted long"


def _sum_bucket(rows: pa.Table) -> pa.Table:
    """Counts over all blocks, for each block in the order of its own hashes; on one row also the different words of the bucket, and their counts."""
    blocks, buckets, kinds, grams, ns, ts = (rows.column(c).to_pylist() for c in ("block", "bucket", "kind", "grams", "n", "t"))
    out = []
    for kind in (1, 2):
        at = [i for i, k in enumerate(kinds) if k == kind]
        if not at:
            continue
        hashes = [_unpack_hashes(grams[i]) for i in at]
        known, place = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = []
        for data in (ns, ts):
            total = np.zeros(len(known), dtype=np.int64)
            np.add.at(total, place, np.concatenate([_unpack(data[i]) for i in at]))
            sums.append(total)
        ends = np.cumsum([len(h) for h in hashes])
        for j, i in enumerate(at):
            own = place[ends[j] - len(hashes[j]) : ends[j]]
            once = (len(known), int(sums[0].sum()), int(sums[1].sum())) if kind == 1 and not j else (0, 0, 0)
            out.append((blocks[i], buckets[i], kind, _pack(sums[0][own]), _pack(sums[1][own]), *once))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table({c.split()[0]: pa.array(x, t) for c, x, t in zip(_SUMS.split(", "), zip(*out), types)})


def _own(text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each gram, how often its text has it (``text`` ascends from 0, ``place`` numbers the different grams)."""
    out, a, known = np.empty(len(place), dtype=np.int32), 0, int(place.max(initial=0)) + 1
    while a < len(place):  # whole texts of about OWN_TOKENS at a time, which bounds the memory of the sort
        b = int(np.searchsorted(text, text[min(a + OWN_TOKENS, len(text)) - 1], "right"))
        _, at, n = np.unique(text[a:b] * known + place[a:b], return_inverse=True, return_counts=True)
        out[a:b] = n[at]
        a = b
    return out


def _losses(n1: np.ndarray, n2: np.ndarray, follows: np.ndarray, total: np.ndarray, size: int, weight: float) -> np.ndarray:
    """Loss of each token from the counts of the words, and of the pairs that end at the places ``follows``.

    A word that ends a text is counted as a context too, so a context with a count may have no pair.
    """
    p = (n1 + 1.0) / (total + (size + 1.0))
    before = n1[follows - 1]
    mixed = weight * n2 / np.maximum(before, 1) + (1 - weight) * p[follows]
    p[follows] = np.where(before > 0, mixed, p[follows])
    return -np.log(p)


def _score(totals: tuple[int, int], size: int, weight: float):
    def run(block: pa.Table, sums: pa.Table) -> pa.Table:
        (row,) = block.to_pylist()
        grams = _block_grams(row["sizes"], row["text"])
        lengths = np.concatenate(grams.lengths)
        follows = np.flatnonzero(np.concatenate(grams.inner)) + 1
        rows = sorted(zip(*(sums.column(c).to_pylist() for c in ("kind", "bucket", "n", "t"))))
        text = np.repeat(np.arange(len(lengths)), lengths)
        wanted = np.array(row["target"], dtype=bool)
        left_out = (wanted, np.ones(len(lengths), dtype=bool))  # documents that the target, and the background, counted
        counts = []  # of the words and of the pairs, each in the target and in all, without the text's own
        for kind, hashes, texts in ((1, grams.words, text), (2, grams.pairs, text[follows])):
            whole = np.concatenate(hashes)
            hashes.clear()
            place = np.unique(whole, return_inverse=True)[1]
            del whole
            own = _own(texts, place)
            for column, out in zip((3, 2), left_out):
                said = [_unpack(r[column]) for r in rows if r[0] == kind]
                counts.append((np.concatenate(said) if said else np.zeros(0, dtype=np.int64))[place] - own * out[texts])
        none = lengths == 0
        means = []
        for model, (total, out) in enumerate(zip(totals, left_out)):
            losses = _losses(counts[model], counts[2 + model], follows, (total - lengths * out)[text], size, weight)
            means.append(np.bincount(text, losses, minlength=len(lengths)) / np.maximum(lengths, 1))
        return pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "n_tokens": pa.array(lengths.astype(np.int64)),
                "target_loss": pa.array(means[0], mask=none),
                "background_loss": pa.array(means[1], mask=none),
                "score": pa.array(means[0] - means[1], mask=none),
            }
        )

    return run


def score_cross_entropy(
    docs: DataFrame, targets: DataFrame, vocabulary_size: int | None = None, weight: float = BIGRAM_WEIGHT
) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) for every row of ``docs``.

    ``targets`` has the doc_ids of the target documents. A text without words
    (null, empty) has no tokens and null losses. Without target documents the
    target model is uniform. Repeated rows count each time, and a row leaves out
    its own counts only; null doc_ids are
    background; other columns are ignored; empty tables give empty results.
    ``vocabulary_size`` is the number of words that the add-one estimate
    provides for (the different words of the corpus unless given); it leaves no
    word out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text"))
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits_of_groups = max(LEAST_BITS, (volume // GROUP_BYTES).bit_length())

    chosen = cut(targets.select(F.col("doc_id").cast("long").alias("_id")).filter("_id is not null").distinct())
    small = chosen.count() * 16 <= BROADCAST_BYTES
    marked = docs.join(F.broadcast(chosen) if small else chosen, docs["doc_id"] == F.col("_id"), "left")
    marked = marked.select("doc_id", "text", F.col("_id").isNotNull().alias("target"))
    # written, so that a block is the same rows in both of its uses
    blocks = cut(marked.mapInArrow(_blocks, _BLOCKS))
    release(chosen)
    counts = blocks.mapInArrow(_count_blocks(bits_of_groups), _COUNTS)
    sums = cut(counts.groupBy("bucket").applyInArrow(_sum_bucket, _SUMS))
    said = sums.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("known", "said", "wanted"))).first()
    size = said["known"] if vocabulary_size is None else vocabulary_size
    sums = sums.select("block", "kind", "bucket", "n", "t")
    return blocks.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(
        _score((said["wanted"], said["said"]), size, weight),
        "doc_id long, n_tokens long, target_loss double, background_loss double, score double",
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0")
    return score_cross_entropy(table(spark, sf_dir, "documents"), good)
