"""Spelling variants: K-d trees over letter counts, range searches per length pair, letter order verified.

Every word is a point: how often it holds each letter. One edit moves a point by
an L1 distance of two (a replaced letter) or one (an inserted or deleted one),
never by none, so the near words of a word lie in a small box around it, among
the words of its own length and of one letter more.

Spark deals the words over cells. A coarse K-d tree per length (its planes from
a bounded sample of the words; they affect balance only) gives every word one
home cell, and sends it as a query to every cell of its length and of the next
that its box reaches. In a cell a K-d tree over the distinct points answers the
queries, dropping whole subtrees whose bounding box is out of reach; of the
points that are found the words are compared letter by letter, through the word
without one letter, so that two large sets of anagrams are joined by key and
not pair by pair.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm.common import batch_columns, cut, release, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Letters a word can hold after lower-casing A-Z.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_LETTER = np.full(0x100, -1, dtype=np.int16)
_LETTER[LETTERS] = np.arange(len(LETTERS))

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
NOISE = 199  # one run in so many loses a letter (op12's contract)
HELD_WORDS = 200_000  # words counted in a task before it passes them on
CELL_WORDS = 20_000  # words a cell is planned for
SAMPLE_WORDS = 50_000  # words the planes of the coarse trees are taken from
LEAF = 24  # points in a leaf of a cell's tree
BLOCK = 256  # query points that go down a tree together
BROADCAST_BYTES = 64 << 20


def lower_az(text: str) -> str:
    """``text`` with A-Z in lower case and nothing else changed (bytes have no other letters)."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def op12_words(doc_id: int | None, text: str) -> Counter:
    """Words of one text under op12's contract: runs lower-cased, one in 199 with a letter deleted."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for run, n in Counter(RUN.findall(lower_az(text))).items():
        h = zlib.crc32(run.encode(), seed)
        if h % NOISE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        found[run] += n
    return found


def plain_words(doc_id: int | None, text: str) -> Counter:
    return Counter(RUN.findall(lower_az(text)))


def _count(words_of, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(*batch_columns(batch, "doc_id", "text")):
                for word, n in words_of(doc_id, text or "").items():
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    return run


def word_counts(docs: DataFrame, words_of=plain_words, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of all texts with their number of occurrences, those of enough letters and occurrences.

    A null text has no words; a null doc_id counts as the empty text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = docs.mapInArrow(_count(words_of, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def code_points(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    return flat.reshape(len(words), -1).astype(np.int32) if words else np.zeros((0, 0), dtype=np.int32)


def letter_counts(words: list[str]) -> np.ndarray:
    """Letter counts of words of one length, a row each."""
    letters = _LETTER[code_points(words)].astype(np.int64)
    flat = np.arange(len(words))[:, None] * len(LETTERS) + letters
    return np.bincount(flat.ravel(), minlength=len(words) * len(LETTERS)).reshape(len(words), -1).astype(np.int32)


class CoarseTree:
    """Planes that divide the points of one length into cells; a cell is a half-open box."""

    def __init__(self, points: np.ndarray, cells: int):
        self.dim, self.at, self.low, self.high, self.cell = [], [], [], [], []
        self.cells = 0
        todo = [(points, max(1, cells), None, None)]
        while todo:
            held, wanted, owner, links = todo.pop()
            node = len(self.dim)
            if owner is not None:
                links[owner] = node
            plane = self._plane(held) if wanted > 1 and len(held) > 1 else None
            for column, value in ((self.dim, -1), (self.at, 0), (self.low, -1), (self.high, -1), (self.cell, -1)):
                column.append(value)
            if plane is None:
                self.cell[node] = self.cells
                self.cells += 1
                continue
            self.dim[node], self.at[node] = plane
            below = held[:, plane[0]] < plane[1]
            todo.append((held[~below], wanted - wanted // 2, node, self.high))
            todo.append((held[below], wanted // 2, node, self.low))

    @staticmethod
    def _plane(points: np.ndarray) -> tuple[int, int] | None:
        """The plane that divides the points most evenly: points below it have fewer of that letter."""
        best = None
        for dim in range(points.shape[1]):
            column = points[:, dim]
            middle = int(np.median(column))
            for at in (middle, middle + 1):
                below = int((column < at).sum())
                uneven = abs(2 * below - len(column))
                if 0 < below < len(column) and (best is None or uneven < best[0]):
                    best = (uneven, dim, at)
        return best[1:] if best else None

    def reached(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, rows): the points whose L1 ball of ``radius`` meets the cell; radius 0: the points inside."""
        todo = [(0, np.arange(len(points)), np.zeros((len(points), 0), dtype=np.int32), ())]
        while todo:
            node, rows, off, dims = todo.pop()
            if not len(rows):
                continue
            if self.cell[node] >= 0:
                yield self.cell[node], rows
                continue
            dim, at = self.dim[node], self.at[node]
            value = points[rows, dim]
            for link, beyond in ((self.low, value - at + 1), (self.high, at - value)):
                beyond = np.maximum(beyond, 0)
                # how far the point is off the box in each letter that has been cut so far
                if dim in dims:
                    k = dims.index(dim)
                    reach = off.copy()
                    reach[:, k] = np.maximum(reach[:, k], beyond)
                    cut_dims = dims
                else:
                    reach, cut_dims = np.column_stack([off, beyond]), (*dims, dim)
                near = reach.sum(axis=1) <= radius
                todo.append((link[node], rows[near], reach[near], cut_dims))


class KdTree:
    """A K-d tree over distinct points with a bounding box per node."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # (start, stop, box low, box high, left, right)
        todo = [(0, len(points), -1, 0)]
        links: dict[tuple[int, int], int] = {}
        while todo:
            start, stop, owner, side = todo.pop()
            held = points[self.order[start:stop]]
            node = len(self.nodes)
            links[owner, side] = node
            low, high = held.min(axis=0), held.max(axis=0)
            if stop - start > LEAF:
                dim = int(np.argmax(high - low))
                middle = (stop - start) // 2
                self.order[start:stop] = self.order[start:stop][np.argpartition(held[:, dim], middle)]
                todo += [(start + middle, stop, node, 1), (start, start + middle, node, 0)]
                self.nodes.append((start, stop, low, high, True))
            else:
                self.nodes.append((start, stop, low, high, False))
        self.links = links

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query rows, point rows) at an L1 distance of exactly ``radius``."""
        todo = [(0, np.arange(len(queries)))] if len(self.points) else []
        while todo:
            node, rows = todo.pop()
            start, stop, low, high, inner = self.nodes[node]
            q = queries[rows]
            rows = rows[(np.maximum(low - q, 0) + np.maximum(q - high, 0)).sum(axis=1) <= radius]
            if not len(rows):
                continue
            if inner:
                todo += [(self.links[node, 0], rows), (self.links[node, 1], rows)]
                continue
            at = self.order[start:stop]
            off = np.abs(queries[rows][:, None, :] - self.points[at][None, :, :]).sum(axis=2)
            i, j = np.nonzero(off == radius)
            yield rows[i], at[j]


def without(word: str, letter: str) -> Iterator[tuple[int, str]]:
    """The word without one occurrence of ``letter``, by its position."""
    at = word.find(letter)
    while at >= 0:
        yield at, word[:at] + word[at + 1 :]
        at = word.find(letter, at + 1)


def replaced(a: list[str], b: list[str], out: str, into: str) -> Iterator[tuple[str, str]]:
    """Pairs of words that differ by ``out`` in place of ``into``, at one position."""
    known = defaultdict(list)
    for word in b:
        for key in without(word, into):
            known[key].append(word)
    for word in a:
        for key in without(word, out):
            for other in known.get(key, ()):
                yield word, other


def lengthened(short: list[str], long: list[str], letter: str) -> Iterator[tuple[str, str]]:
    """Pairs (short, long) in which the long word holds one ``letter`` more."""
    wanted = set(short)
    for word in long:
        for rest in {rest for _, rest in without(word, letter)}:
            if rest in wanted:
                yield rest, word


def _by_point(words: list[str]) -> tuple[np.ndarray, list[list[str]]]:
    """The distinct points of words of one length, and the words at each."""
    points, where = np.unique(letter_counts(words), axis=0, return_inverse=True)
    groups: list[list[str]] = [[] for _ in points]
    for word, at in zip(words, where.ravel().tolist()):
        groups[at].append(word)
    return points, groups


def near_words(queries: list[str], words: list[str], longer: bool) -> Iterator[tuple[str, str]]:
    """(query, word) one edit apart: of one length, or ``longer`` words of one letter more."""
    if not queries or not words:
        return
    q, q_words = _by_point(queries)
    p, p_words = _by_point(words)
    tree = KdTree(p)
    for start in range(0, len(q), BLOCK):
        for rows, found in tree.within(q[start : start + BLOCK], 1 if longer else 2):
            steps = p[found] - q[start + rows]
            more, fewer = steps.argmax(axis=1), steps.argmin(axis=1)
            # a point at distance two may also differ by two of one letter, which no single edit does
            fits = steps.max(axis=1) == 1
            for i, j, up, down in zip((rows + start)[fits].tolist(), found[fits].tolist(), more[fits].tolist(), fewer[fits].tolist()):
                if longer:
                    yield from lengthened(q_words[i], p_words[j], chr(LETTERS[up]))
                else:
                    yield from replaced(q_words[i], p_words[j], chr(LETTERS[down]), chr(LETTERS[up]))


def coarse_trees(words: DataFrame, cell_words: int = CELL_WORDS, sample_words: int = SAMPLE_WORDS) -> dict[int, CoarseTree]:
    """Length -> its coarse tree. A length with at most ``cell_words`` words is one cell and needs no tree."""
    sizes = {r["length"]: r["n"] for r in words.groupBy("length").agg(F.count("*").alias("n")).collect()}
    large = {length: n for length, n in sizes.items() if n > cell_words}
    if not large:
        return {}
    total = sum(large.values())
    spread = F.pmod(F.xxhash64("word"), F.lit(1 << 30))
    some = words.filter(F.col("length").isin(list(large)))
    if total > sample_words:
        some = some.filter(spread < int(min(1.0, 2 * sample_words / total) * (1 << 30)))
    sample = defaultdict(list)
    for row in some.orderBy(spread, "word").limit(sample_words).select("word", "length").collect():
        sample[row["length"]].append(row["word"])
    return {length: CoarseTree(letter_counts(sample[length]), -(-n // cell_words)) for length, n in large.items() if sample[length]}


def _deal(trees):
    """Words -> (length, cell, role, word): at home (role 0), as a query of equal (1) and of longer words (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = trees.value
        for batch in batches:
            by_length = defaultdict(list)
            for word in batch_columns(batch, "word")[0]:
                by_length[len(word)].append(word)
            for length, words in by_length.items():
                points = letter_counts(words)
                for role, target, radius in ((0, length, 0), (1, length, 2), (2, length + 1, 1)):
                    tree = planes.get(target)
                    cells = tree.reached(points, radius) if tree else [(0, np.arange(len(words)))]
                    for cell, rows in cells:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([target] * len(rows), pa.int32()),
                                pa.array([cell] * len(rows), pa.int32()),
                                pa.array([role] * len(rows), pa.int32()),
                                pa.array([words[i] for i in rows.tolist()], pa.string()),
                            ],
                            names=["length", "cell", "role", "word"],
                        )

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell -> (word, near), both ways. One cell's words are held at a time."""

    def cells() -> Iterator[list[list[str]]]:
        now, held = None, [[], [], []]
        for batch in batches:
            for length, cell, role, word in zip(*batch_columns(batch, "length", "cell", "role", "word")):
                if (length, cell) != now:
                    if now is not None:
                        yield held
                    now, held = (length, cell), [[], [], []]
                held[role].append(word)
        if now is not None:
            yield held

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["word", "near"])

    a: list[str] = []
    b: list[str] = []
    for words, equal, shorter in cells():
        # equal words are asked from both sides, a shorter and a longer word from one
        for query, word in near_words(equal, words, False):
            a.append(query)
            b.append(word)
        for query, word in near_words(shorter, words, True):
            a += (query, word)
            b += (word, query)
        if len(a) >= HELD_WORDS:
            yield out(a, b)
            a, b = [], []
    yield out(a, b)


def near_pairs(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, near) for all words of ``words`` (distinct) that differ by one inserted, deleted or replaced letter, both ways."""
    sized = words.select("word", F.length("word").alias("length"))
    trees = words.sparkSession.sparkContext.broadcast(coarse_trees(sized, cell_words))
    dealt = sized.select("word").mapInArrow(_deal(trees), "length int, cell int, role int, word string")
    # little data, much work: the number of tasks is stated, so that small partitions are not put together
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, "length", "cell").sortWithinPartitions("length", "cell")
    return dealt.mapInArrow(_pairs, "word string, near string")


def spelling_forms(counts: DataFrame, ratio: int = RATIO, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n, form, root, n_near, form_n) for every row of ``counts`` (word, n; distinct words).

    ``form`` is the near word of largest n (ties: smallest by code point) if it
    occurs ``ratio`` times as often, else null; ``root`` is where the forms lead.
    Words hold letters of ``LETTERS`` only. No words: no rows.
    """
    counts = cut(counts.select("word", "n"))
    pairs = near_pairs(counts, cell_words).join(counts.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    found = counts.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("b.near").alias("near"), (-F.col("b.m")).alias("near_n")
    )
    is_form = F.col("near_n") >= ratio * F.col("n")
    found = found.select("word", "n", F.when(is_form, F.col("near")).alias("form"), "n_near", F.when(is_form, F.col("near_n")).alias("form_n"))
    out = cut(found.withColumn("root", F.coalesce("form", "word")))
    release(counts)
    # n grows at least ``ratio``-fold along a chain; each round doubles how far a root has been followed
    while True:
        # only roots that have a form of their own lead on: one row per such word
        ahead = cut(out.filter("root <> word").select(F.col("word").alias("root"), F.col("root").alias("next")).join(
            out.filter("root <> word").select("root").distinct(), "root", "left_semi"
        ))
        rows = ahead.count()
        if not rows:
            release(ahead)
            return out.select("word", "form", "root", "n", "n_near", "form_n")
        small = F.broadcast(ahead) if rows * 160 <= BROADCAST_BYTES else ahead
        stepped = out.join(small, "root", "left").withColumn("root", F.coalesce("next", "root")).select(*out.columns)
        old, out = out, cut(stepped)
        release(old, ahead)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(word_counts(table(spark, sf_dir, "documents"), op12_words))
