"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Every text becomes its set of distinct word shingles. Shingles are ordered
rare first by a count sketch over all texts; two sets of Jaccard similarity t
or more share a shingle among the first ``n - ceil(t * n) + 1`` of each, so
only those prefixes meet in a join. Candidates pass the length and positional
filters in the join, then the suffix filter and one exact verification per
pair.

A group of copies is not expanded into all pairs. Texts with equal sets are
one class. Within the texts that share a prefix shingle, pairs are checked
against a few hubs per round; pairs already in the same component are left
out, a checked hub leaves the group, and rounds go on until no group joins
two components. Every pair that could link two components is thus verified,
and the components are those of the complete link graph.

The number of links of a text is counted afterwards, inside its component, where
all its links are: the different sets of a component are dealt into blocks of
bounded size, every two blocks meet in one task, and only counts leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiontally.llm.common import (
    SKETCH_BITS,
    Sketch,
    as_bytes,
    batch_columns,
    chunks,
    cut,
    distinct_sorted,
    gather_sketch,
    release,
    shingles,
    table,
)
from regiontally.llm.components import contract

KEY_BITS = 20  # high bits of an ordering key: the sketch count
HEAVY = 10_000  # a bucket above this count (and twice the mean) may hold a hot shingle
BROADCAST_BYTES = 64 << 20
HUB_GROWTH = 64  # hubs per group: 1, then so many times more in each round
BLOCK_SETS = 512  # different sets in a block of the link count, on average
BLOCK_BYTES = 8 << 20  # and the bytes of their shingle hashes
COLUMNS = 4096  # shingles per step of a block's overlap product


def _summarise(n: int, bits: int):
    """(doc_id, n, fp) per text, then the task's sketch as slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(bits)
        for batch in batches:
            ids, texts = batch_columns(batch, "doc_id", "text")
            for first, held in chunks(texts):
                hashes, cuts = distinct_sorted(*shingles(held, n))
                sketch.add(hashes)
                parts = [hashes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[first : first + len(held)], pa.int64()),
                        pa.array(np.diff(cuts), pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(p) for p in parts], pa.binary()),
                        pa.nulls(len(held), pa.int32()),
                        pa.nulls(len(held), pa.binary()),
                    ],
                    names=["doc_id", "n", "fp", "slice", "data"],
                )
        for at, data in sketch.slices():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([at], pa.int32()), pa.array([data], pa.binary())],
                names=["doc_id", "n", "fp", "slice", "data"],
            )

    return run


def order_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Total order, rare first: sketch count in the high bits, hash bits below."""
    seen = counts[(hashes & np.uint64(len(counts) - 1)).astype(np.int64)].astype(np.uint64)
    seen = np.minimum(seen, np.uint64((1 << (KEY_BITS - 1)) - 1))
    return (seen << np.uint64(64 - KEY_BITS)) | (hashes >> np.uint64(KEY_BITS))


def needed(n, percent: int):
    """Smallest overlap of any partner with a set of ``n``: ceil(t * n)."""
    return (percent * n + 99) // 100


def _prefixes(n: int, percent: int, counts, heavy: int):
    """(token, doc_id, n, pos, hot, salt) for the rare-first prefix of every set; hot tokens are salted by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = counts.value
        for batch in batches:
            ids, texts = batch_columns(batch, "doc_id", "text")
            for first, held in chunks(texts):
                hashes, cuts = distinct_sorted(*shingles(held, n))
                keys = order_keys(hashes, table_)
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    keys[a:b].sort()
                sizes = np.diff(cuts)
                lengths = np.where(sizes > 0, sizes - needed(sizes, percent) + 1, 0)
                total = int(lengths.sum())
                pos = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                token = keys[np.repeat(cuts[:-1], lengths) + pos]
                doc = np.array([0 if i is None else i for i in ids[first : first + len(held)]], dtype=np.int64)
                known = np.repeat(np.array([i is not None for i in ids[first : first + len(held)]]), lengths)
                hot = (token >> np.uint64(64 - KEY_BITS)) > heavy
                owner = np.repeat(doc, lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token.view(np.int64)[known]),
                        pa.array(owner[known]),
                        pa.array(np.repeat(sizes, lengths)[known]),
                        pa.array(pos[known]),
                        pa.array(hot[known]),
                        pa.array(np.where(hot, owner, 0)[known]),
                    ],
                    names=["token", "doc_id", "n", "pos", "hot", "salt"],
                )

    return run


def suffix_bound(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    """Upper bound of the overlap of two sorted arrays, by splitting at a pivot."""
    if depth == 0 or not len(x) or not len(y):
        return min(len(x), len(y))
    middle = len(y) // 2
    at = int(np.searchsorted(x, y[middle]))
    found = int(at < len(x) and x[at] == y[middle])
    return suffix_bound(x[:at], y[:middle], depth - 1) + found + suffix_bound(x[at + found :], y[middle + 1 :], depth - 1)


def _verify(n: int, percent: int):
    """Pairs with both texts -> the linked pairs."""

    def sets(known: dict, key: int, text: bytes) -> np.ndarray:
        # the text decides too, so that a repeated doc_id keeps its sets apart
        name = (key, xxhash.xxh3_64_intdigest(text))
        if name not in known:
            if len(known) >= 64:
                known.pop(next(iter(known)))
            known[name] = distinct_sorted(*shingles([text], n))[0]
        return known[name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            ids_a, ids_b, texts_a, texts_b = batch_columns(batch, "a", "b", "text_a", "text_b")
            keep = []
            for a, b, ta, tb in zip(ids_a, ids_b, texts_a, texts_b):
                x, y = sets(known, a, ta), sets(known, b, tb)
                # |x & y| * 100 >= percent * |x | y|
                least = -(-percent * (len(x) + len(y)) // (100 + percent))
                linked = suffix_bound(x, y, 3) >= least
                if linked:
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    linked = 100 * shared >= percent * (len(x) + len(y) - shared)
                keep.append(linked)
            keep = np.array(keep, dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(ids_a, dtype=np.int64)[keep]), pa.array(np.array(ids_b, dtype=np.int64)[keep])], names=["a", "b"]
            )

    return run


def jaccard_components(
    docs: DataFrame, percent: int = 75, n: int = 5, sketch_bits: int = SKETCH_BITS, heavy: int | None = None
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``doc_id`` and ``text`` are read, other columns are ignored. A null or empty
    text (or one without words) has no shingles and is its own component. Rows
    that repeat a doc_id are one document with several texts and share their
    links. A row without doc_id links with nothing; its component is null. An
    empty table gives an empty result. ``heavy`` is the count from which a shingle
    is dealt by document; it changes the work, not the result.
    """
    member, labels = _components(docs, percent, n, sketch_bits, heavy)
    return _named(member, labels).drop("fp")


def jaccard_links(
    docs: DataFrame, percent: int = 75, n: int = 5, block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The columns of ``jaccard_components`` and ``n_links``, the number of other rows that a row links with.

    Copies count as links, one each; so do rows that repeat a doc_id, which are
    counted as texts of their own. A row without shingles or without doc_id has
    no links. ``block_sets`` and ``block_bytes`` bound what meets in one task;
    they change the work, not the result.
    """
    member, labels = _components(docs, percent, n, SKETCH_BITS, None)
    has_set = member.filter("n > 0 and doc_id is not null")
    # copies are one class: its weight is their number
    classes = has_set.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.first("n").alias("n"))
    classes = cut(classes.join(labels, classes["rep"] == labels["node"]).select("fp", "rep", "weight", "n", "comp"))
    blocks = F.greatest(
        F.ceil(F.count("*") / F.lit(block_sets)), F.ceil(F.sum(F.col("n") * 8) / F.lit(block_bytes)), F.lit(1)
    )
    # a component of one class has no links but those of its copies
    dealt = cut(classes.groupBy("comp").agg(blocks.alias("blocks"), F.count("*").alias("sets")).filter("sets > 1").select("comp", "blocks"))
    several = cut(classes.join(dealt, "comp").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks"))))

    ids = several.select(F.col("rep").alias("doc_id")).distinct()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text")).join(ids, "doc_id", "left_semi")
    sets = source.mapInArrow(_sets(n), "fp binary, hashes binary").dropDuplicates(["fp"])
    sets = cut(several.select("fp", "weight", "comp", "blocks", "block").join(sets, "fp"))
    # block k meets itself and every other block once: rows (low, high) of which it is one
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    met = sets.withColumn("other", other).select(
        "comp", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "fp", "weight", "hashes"
    )
    counted = met.groupBy("comp", "low", "high").applyInArrow(_count_links(percent), "fp binary, links long")
    linked = counted.groupBy("fp").agg(F.sum("links").alias("links"))
    per_class = cut(
        classes.join(linked, "fp", "left").select("fp", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    release(classes, dealt, several, sets)
    out = _named(member, labels)
    of_rows = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("n_links")).otherwise(F.lit(0)).cast("long")
    return out.join(per_class, "fp", "left").select("doc_id", "n_shingles", "component_id", of_rows.alias("n_links"))


def _sets(n: int):
    """(fp, sorted shingle hashes) per text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (texts,) = batch_columns(batch, "text")
            for _, held in chunks(texts):
                hashes, cuts = distinct_sorted(*shingles(held, n))
                parts = [hashes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(p) for p in parts], pa.binary()), pa.array(parts, pa.binary())], names=["fp", "hashes"]
                )

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = COLUMNS) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, by products of 0/1 matrices of ``columns`` shingles."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    for at in range(0, len(shared), columns):
        part = shared[at : at + columns]
        sides = []
        for sets in (left, right):
            held = np.zeros((len(sets), len(part)), dtype=np.float32)
            for i, x in enumerate(sets):
                x = x[np.searchsorted(x, part[0]) : np.searchsorted(x, part[-1], "right")]
                spot = np.searchsorted(part, x)
                held[i, spot[part[spot] == x]] = 1
            sides.append(held)
        out += (sides[0] @ sides[1].T).astype(np.int64)  # counts up to ``columns`` are exact in 32-bit floats
    return out


def _count_links(percent: int):
    """Two blocks of a component -> (fp, weight of the other block's sets that it links with)."""

    def run(rows: pa.Table) -> pa.Table:
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        side = rows.column("block").to_numpy()
        fps = np.array(rows.column("fp").to_pylist(), dtype=object)
        weight = rows.column("weight").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("hashes").to_pylist()]
        a, b = np.flatnonzero(side == low), np.flatnonzero(side == high)
        if not len(a) or not len(b):
            return pa.table({"fp": pa.array([], pa.binary()), "links": pa.array([], pa.int64())})
        size = np.array([len(x) for x in sets])
        shared = overlaps([sets[i] for i in a], [sets[i] for i in b])
        linked = 100 * shared >= percent * (size[a][:, None] + size[b][None, :] - shared)
        links = np.zeros(len(sets), dtype=np.int64)
        if low == high:
            np.fill_diagonal(linked, False)
            links[a] = linked @ weight[b]
        else:
            links[a] = linked @ weight[b]
            links[b] = weight[a] @ linked
        return pa.table({"fp": pa.array(fps.tolist(), pa.binary()), "links": pa.array(links, pa.int64())})

    return run


def _components(docs: DataFrame, percent: int, n: int, sketch_bits: int, heavy: int | None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, fp) of every row and (node, comp) of every document with a set."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text"))

    seen = cut(docs.mapInArrow(_summarise(n, sketch_bits), "doc_id long, n long, fp binary, slice int, data binary"))
    counts = gather_sketch(seen.filter("slice is not null"), sketch_bits)
    heavy = max(HEAVY, 2 * int(counts.mean())) if heavy is None else heavy
    heavy = min(heavy, (1 << (KEY_BITS - 1)) - 2)
    member = seen.filter("slice is null").select("doc_id", "n", "fp")
    has_set = member.filter("n > 0 and doc_id is not null")
    first = has_set.groupBy("fp").agg(F.min("doc_id").alias("rep"))

    shared = spark.sparkContext.broadcast(counts.astype(np.uint32))
    rows = docs.mapInArrow(_prefixes(n, percent, shared, heavy), "token long, doc_id long, n long, pos long, hot boolean, salt long")
    # heavy shingles are spread by document and kept; the others need a partner
    rows = rows.withColumn("met", F.count("*").over(Window.partitionBy("token", "salt"))).filter("met > 1 or hot")
    rows = rows.join(first.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    # ``met``: how many shingles of its prefix a document shares; the text that others were edited from shares the most
    rows = rows.select("token", F.col("doc_id").alias("node"), "n", "pos")
    rows = cut(rows.withColumn("met", F.count("*").over(Window.partitionBy("node"))))

    labels = has_set.join(first, "fp").select(F.col("doc_id").alias("node"), F.col("rep").alias("comp"))
    # rows that repeat a doc_id join the classes of their texts
    ends = labels.groupBy("node").agg(F.min("comp").alias("a"), F.max("comp").alias("b"))
    labels = contract(cut(ends.select("node", F.col("a").alias("comp"))), ends.select("a", "b"))

    texts = None
    hubs_per_token = 1
    checked: list[DataFrame] = []
    left_over = rows
    while True:
        # only groups that join two components can hold a link that matters
        labelled = left_over.select("token", "node", "n", "pos", "met").join(labels, "node")
        open_ = labelled.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
        old, rows = rows, cut(labelled.join(open_.select("token"), "token", "left_semi"))
        release(old)
        if rows.isEmpty():
            break
        if texts is None:
            texts = _texts_of(docs, rows)
        group = F.pmod(F.hash("node"), F.lit(hubs_per_token))
        best = F.max_by(F.struct("node", "n", "pos", "comp"), F.struct("met", -F.col("node")))
        hubs = rows.groupBy("token", group.alias("part")).agg(best.alias("hub")).select("token", "hub")
        pairs = rows.join(hubs, "token").filter("comp <> hub.comp")
        pairs = pairs.filter(_may_link(percent)).select(
            F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")
        ).distinct()
        for before in checked:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = cut(pairs)
        if not pairs.isEmpty():
            checked.append(pairs)
            left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
            right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
            found = pairs.join(right, "b").join(left, "a").mapInArrow(_verify(n, percent), "a long, b long")
            edges = found.join(labels.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a").join(
                labels.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b"
            )
            labels = contract(labels, edges.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        # every pair of a hub has been checked: it leaves the group
        left_over = rows.join(hubs.select("token", F.col("hub.node").alias("node")), ["token", "node"], "left_anti")
        hubs_per_token *= HUB_GROWTH
    release(rows, texts, *checked)

    return member, labels


def _named(member: DataFrame, labels: DataFrame) -> DataFrame:
    """(fp, doc_id, n_shingles, component_id); components are named by class representatives: the smallest doc_id of one is among them."""
    out = member.join(labels, member["doc_id"] == labels["node"], "left")
    name = F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("doc_id"))
    return out.select("fp", "doc_id", F.col("n").alias("n_shingles"), name.alias("component_id"))


def _may_link(percent: int):
    """Length and positional filter of a row against its hub, for the first shingle that the two share.

    Nothing ahead of the first shared shingle is shared, so from there on both
    sets must still hold the whole overlap that the threshold asks for:
    ``percent / (100 + percent)`` of the two sizes together.
    """
    n, pos, hn, hpos = F.col("n"), F.col("pos"), F.col("hub.n"), F.col("hub.pos")
    length = (F.lit(100) * F.least(n, hn)) >= (F.lit(percent) * F.greatest(n, hn))
    return length & ((F.lit(100 + percent) * F.least(n - pos, hn - hpos)) >= (F.lit(percent) * (n + hn)))


def _texts_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts of the documents that share a prefix shingle with another."""
    ids = cut(rows.select(F.col("node").alias("doc_id")).distinct())
    # broadcast only when the ids (16 bytes each in the join's map) fit the bound
    if ids.count() * 16 <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    return cut(docs.join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text"))


def keep_one_per_group(docs: DataFrame, percent: int = 75, n: int = 5) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id.

    Of rows that repeat a doc_id one stays; rows without doc_id all stay.
    """
    groups = jaccard_components(docs, percent, n)
    kept = cut(groups.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__rows")))
    ids = kept.select("__id")
    # ids of 8 bytes, 16 in the join's map: broadcast behind a check, else Spark joins by id
    if kept.count() * 16 <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    chosen = docs.join(ids, F.col("doc_id").cast("long") == F.col("__id"), "left_semi")
    if not kept.filter("__rows > 1").isEmpty():
        chosen = chosen.dropDuplicates(["doc_id"])
    return chosen.unionAll(docs.filter("doc_id is null"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(table(spark, sf_dir, "documents"))
