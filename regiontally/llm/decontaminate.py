"""Benchmark decontamination: word pairs as seeds, then local alignment.

The benchmark is the stated query set; it is taken in blocks of a bounded size.
Every window of words that may hold an item at the asked score is scored by
Smith-Waterman alignment over words, as a share of the score of a whole copy,
so edited copies count by how much of the item they keep.

Seeds lose no copy. An alignment of an item of L words with M matches scores 2 M
less one for each word replaced, left out or put in. Call neighbouring matches
with at most one such edit between them a close pair: its words are one or two
places apart in the item and in the text. All other neighbours cost 2 or more,
so a score of 2 * least * L needs at least T = least * L - 1 close pairs, each of
which starts at another word of the item and of the text. Any L - T starting
words of the item thus have one that is hit; the seeds are those whose pairs
are the rarest in the benchmark, which matters to the speed only. A window
around a hit is aligned if T of its words start a pair of the item. No seed is
left out for being frequent in the corpus.

Words are compared in lower case and without ASCII punctuation.
"""

from __future__ import annotations

import math
import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm.common import _ORDER, batch_columns, chunks, cut, mix, ngram_hashes, table, word_hashes

BLOCK_BYTES = 16 << 20  # text of the benchmark items of one block
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
CACHED = 20_000  # alignments a task remembers, so that copies of a text cost one
_PUNCTUATION = string.punctuation.encode()
_MASK_BITS = 24


def normalise(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(None, _PUNCTUATION)


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """Two rows: hash of each word with the next one and with the one after; a pair beyond the end is 0."""
    out = np.zeros((2, len(words)), dtype=np.uint64)
    first, second = mix(words * _ORDER[0]), mix(words * _ORDER[1])
    for gap in (1, 2):
        out[gap - 1, : max(0, len(words) - gap)] = mix(first[:-gap] + second[gap:])
    return out


class Items:
    """The items of a block: their words as hashes, and the items of each seed."""

    def __init__(self, rows: list[tuple[int, str | None]], least: float):
        self.ids, self.words, self.needed, self.reach, self.floor = [], [], [], [], []
        for item, text in rows:
            words = word_hashes(np.frombuffer(normalise(text), dtype=np.uint8))[2]
            if len(words):
                self.ids.append(item)
                self.words.append(words)
                self.needed.append(math.ceil(least * len(words) - 1 - 1e-9))
                # words of a text that an alignment of the asked score can span
                self.reach.append(math.ceil((3 - 2 * least) * len(words)) + 2)
                # hits that are left of the needed ones without the most frequent starting words
                self.floor.append(max(1, -(-self.needed[-1] // 3)))
        pairs = [pair_hashes(w) for w in self.words]
        known, counts = np.unique(np.concatenate([p.ravel() for p in pairs]) if pairs else np.zeros(0, np.uint64), return_counts=True)
        seeds, of = [], []
        self.whole: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for i, (words, pair, needed) in enumerate(zip(self.words, pairs, self.needed)):
            if needed < 1:  # one word could reach the score: such an item is one seed as a whole
                self.whole[len(words)][int(ngram_hashes(words, len(words))[0])].append(i)
                continue
            starts = pair[:, :-1]
            often = np.where(starts == 0, 0, counts[np.searchsorted(known, starts)]).sum(axis=0)
            left_out = needed - self.floor[i]
            chosen = np.unique(starts[:, np.argsort(often, kind="stable")[: len(words) - 1 - left_out]])
            chosen = chosen[chosen != 0]
            seeds.append(chosen)
            of.append(np.full(len(chosen), i, dtype=np.int64))
        self.whole = {size: dict(found) for size, found in self.whole.items()}
        seeds_, of_ = (np.concatenate(x) if x else np.zeros(0, dtype=t) for x, t in ((seeds, np.uint64), (of, np.int64)))
        order = np.argsort(seeds_, kind="stable")
        self.seeds, self.of = seeds_[order], of_[order]

    def mask(self) -> np.ndarray:
        out = np.zeros(1 << _MASK_BITS, dtype=bool)
        out[(self.seeds & np.uint64(len(out) - 1)).astype(np.int64)] = True
        return out

    def hits(self, words: np.ndarray, pairs: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the seeds of a run of words."""
        found = []
        for row in pairs:
            near = np.flatnonzero(mask[(row & np.uint64(len(mask) - 1)).astype(np.int64)])
            at = np.searchsorted(self.seeds, row[near])
            at[at == len(self.seeds)] = 0
            near = near[self.seeds[at] == row[near]] if len(self.seeds) else near[:0]
            found.append((near, row[near]))
        for size, known in self.whole.items():
            grams = ngram_hashes(words, size)
            near = np.flatnonzero(np.isin(grams, np.array(list(known), dtype=np.uint64)))
            found.append((near, grams[near]))
        place, seed = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(place, kind="stable")
        return place[order], seed[order]

    def owners(self, place: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hits once per item that the seed belongs to: (place, item)."""
        low, high = np.searchsorted(self.seeds, seed, "left"), np.searchsorted(self.seeds, seed, "right")
        n = high - low
        at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        places, items = [np.repeat(place, n)], [self.of[at]]
        for known in self.whole.values():
            for k in np.flatnonzero(n == 0):
                owned = known.get(int(seed[k]), ())
                places.append(np.full(len(owned), place[k]))
                items.append(np.array(owned, dtype=np.int64))
        return np.concatenate(places).astype(np.int64), np.concatenate(items)

    def windows(self, place: np.ndarray, item: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, low, high) wherever enough hits of an item stand within the span of an alignment.

        ``low`` and ``high`` are places of the buffer, not cut at the text's ends; windows of one text and item are disjoint.
        """
        if not len(place):
            return
        group = text * len(self.ids) + item
        order = np.lexsort((place, group))
        place, group = place[order], group[order]
        new = np.ones(len(place), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (group[1:] != group[:-1])
        place, group = place[new], group[new]
        item = group % len(self.ids)
        reach = np.array(self.reach, dtype=np.int64)[item]
        ahead = np.arange(len(place)) + np.array(self.floor, dtype=np.int64)[item] - 1
        inside = ahead < len(place)
        ahead = np.minimum(ahead, len(place) - 1)
        close = np.flatnonzero(inside & (group[ahead] == group) & (place[ahead] - place <= reach))
        now = None
        for g, low, high in zip(group[close].tolist(), (place - reach)[close].tolist(), (place[ahead] + reach)[close].tolist()):
            if now is not None and now[0] == g and low <= now[2]:
                now[2] = max(now[2], high)
                continue
            if now is not None:
                yield now[0] // len(self.ids), now[0] % len(self.ids), now[1], now[2]
            now = [g, low, high]
        if now is not None:
            yield now[0] // len(self.ids), now[0] % len(self.ids), now[1], now[2]


def align(window: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of an item in a window, and the window place where it ends."""
    m = len(window)
    slope = GAP * np.arange(1, m + 1)
    last = np.zeros(m + 1, dtype=np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(window == word, MATCH, MISMATCH)
        now = np.maximum(np.maximum(last[:-1] + step, last[1:] + GAP), 0)
        # gaps along the window: a running maximum in a frame that falls by GAP a word
        now = np.maximum.accumulate(now - slope) + slope
        last[1:] = np.maximum(now, 0)
        top = int(last.argmax())
        if last[top] > best:
            best, end = int(last[top]), top
    return best, end


def _leak_in(items: Items, i: int, own: np.ndarray, pairs: np.ndarray, low: int, high: int, least: float, held: dict) -> tuple | None:
    """(item_id, score, start, end) of item ``i`` in the words ``low`` to ``high`` of a text, if it reaches the asked score."""
    item, needed = items.words[i], items.needed[i]
    low, high = max(0, low), min(high, len(own))
    window = own[low:high]
    key = (window.tobytes(), i)
    if key not in held:
        if len(held) > CACHED:
            held.clear()
        found = (0.0, 0, 0)
        if needed > 0:
            if ("pairs", i) not in held:
                known = np.unique(pair_hashes(item))
                held["pairs", i] = known[known != 0]
            enough = np.isin(pairs[:, low:high], held["pairs", i]).any(axis=0).sum() >= needed
        if needed < 1 or enough:
            score, end = align(window, item)
            share = score / (MATCH * len(item))
            # the start is where the mirrored alignment of what lies before the end stops
            back = align(window[:end][::-1], item[::-1])[1] if share >= least else 0
            found = share, end - back, end
        held[key] = found
    share, start, end = held[key]
    return (items.ids[i], share, low + start, low + end) if share >= least else None


def _find(shared, least: float):
    names = ["key", "item_id", "score", "word_start", "word_end"]
    kinds = [pa.string(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        mask, cache = items.mask(), {}
        for batch in batches:
            keys, texts = batch_columns(batch, "key", "text")
            rows = []
            for first, held in chunks(map(normalise, texts)):
                data = np.frombuffer(b"\n".join(held), dtype=np.uint8)
                starts, _, words = word_hashes(data)
                ends = np.cumsum(np.fromiter(map(len, held), dtype=np.int64, count=len(held)) + 1)
                bounds = np.searchsorted(starts, np.concatenate(([0], ends)))
                pairs = pair_hashes(words)
                # pairs that would join two texts are none
                for k in (1, 2):
                    last = bounds[1:] - k
                    for row in range(2 - k + 1):
                        pairs[k - 1 + row, last[last >= bounds[:-1]]] = 0
                place, seed = items.hits(words, pairs, mask)
                place, item = items.owners(place, seed)
                text = np.searchsorted(bounds, place, side="right") - 1
                for t, i, a, b in items.windows(place, item, text):
                    low, high = int(bounds[t]), int(bounds[t + 1])
                    key = keys[first + t]
                    if key is None:
                        continue
                    found = _leak_in(items, i, words[low:high], pairs[:, low:high], a - low, b - low, least, cache)
                    if found:
                        rows.append((key, *found))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: float = MIN_SCORE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, item_id, score, word_start, word_end): the best alignment of each item in each text that holds it.

    ``docs`` has (key string, text); rows without a key or words match nothing.
    Items without words or item_id are left out; rows that repeat an item_id
    are one item with several texts. Either table may be empty.
    """
    spark = docs.sparkSession
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-size // block_bytes)
    out = None
    for block in range(blocks):
        # a block holds block_bytes of text, give or take the spread of the hash: the bound of what is sent out
        part = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = Items([(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()], least)
        shared = spark.sparkContext.broadcast(items)
        scored = cut(docs.select("key", "text").mapInArrow(_find(shared, least), "key string, item_id long, score double, word_start int, word_end int"))
        out = scored if out is None else out.unionAll(scored)
    if out is None:
        return spark.createDataFrame([], "key string, item_id long, score double, word_start int, word_end int")
    best = F.max(F.struct("score", (-F.col("word_start")).alias("s"), (-F.col("word_end")).alias("e"))).alias("b")
    out = out.groupBy("key", "item_id").agg(best)
    return out.select("key", "item_id", F.col("b.score").alias("score"), (-F.col("b.s")).alias("word_start"), (-F.col("b.e")).alias("word_end"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text holds no item; rows are told apart by their text, whatever their doc_id."""
    key = F.md5(F.col("text").cast("binary"))
    leaks = cut(find_leaks(docs.select(key.alias("key"), "text"), benchmark, least).select(F.col("key").alias("__key")).distinct())
    # 32 characters and the map's overhead a row; beyond the bound Spark joins by key
    small = leaks.count() * 100 <= 64 << 20
    return docs.join(F.broadcast(leaks) if small else leaks, key == F.col("__key"), "left_anti")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "text")
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return leaks.select(F.col("key").cast("long").alias("doc_id"), "item_id", "score", "word_start", "word_end")
