"""Removal of repeated byte strings by a column-wise multi-document construction.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, in any text, is removed.

Spark brings together what can be equal. For every window of ``length`` bytes
the smallest hash of an ``ANCHOR``-byte string inside it is its anchor, so equal
windows share their anchor at the same offset. Consecutive windows with one
anchor form a piece; a piece is 400 to about 600 bytes. Anchors that occur once
rule out their windows, and equal pieces are one piece with a count, so only
different pieces around one anchor are left to compare.

Those are the documents of the construction. They are aligned at their anchor,
and each round inserts one symbol per piece, from the right end to the left:
the round's order (the Burrows-Wheeler transform of the suffixes that start in
this column) follows from the last by a stable sort of the inserted symbols,
and the common prefix of neighbours from a range minimum over the last round's
common prefixes. Equal windows stand in the same column, so suffixes of
different columns need not be merged. Each round's symbols, order and common
prefixes are appended to column files, and a second, sequential pass over those
files reads off the windows whose common prefix with a neighbour reaches
``length``. The shared anchor is one symbol of ``ANCHOR`` bytes.

Groups are packed into tasks of bounded size. A group with more than
``MAX_GROUP`` different pieces is not built in one task: its windows are
counted by hash in a distributed aggregation instead, which is exact and has no
hot key.

Two lengths cost little more than the shorter one (``with_nested_spans``): all
windows of a repeated string are repeated, so a repeated string of ``LENGTH``
bytes lies inside one run of what repeated strings of ``PASSAGE`` bytes cover,
and only those runs are built again.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm import common
from regiontally.llm.common import as_bytes, batch_columns, chunks, cut, mix, release, table

LENGTH = 400
ANCHOR = 208
PASSAGE = 200  # what any passage of over 50 words of three letters holds (drop_repeats, with_nested_spans)
MAX_GROUP = 4096
BLOCK_PIECES = 2048
PART_BYTES = 4 << 20
FIND_BYTES = 128 << 10  # of text hashed at a time: the arrays of a chunk stay in cache
SLICE_ROWS = 512  # of a batch turned into Python objects at a time
BROADCAST_BYTES = 64 << 20
_PLACE = np.uint64((1 << 24) - 1)  # place of a hash in its buffer, below 16 MB


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which the hash of any substring follows (see ``substring_hash``)."""
    up, down = common._power(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(common._BYTE[data] * up[: len(data)], out=sums[1:])
    return sums, down


def substring_hash(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * down[start])


def find_pieces(texts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR):
    """Pieces of a chunk: text index, first and last window start, anchor place (in the text), anchor and piece hash."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, empty, empty
    sums, down = prefix_hashes(data)
    grams = mix((sums[anchor:] - sums[:-anchor]) * down[: len(data) - anchor + 1])
    m, w = len(grams), length - anchor + 1
    keys = (grams & ~_PLACE) | np.arange(m, dtype=np.uint64)
    padded = np.concatenate([keys, np.full(-m % w, ~np.uint64(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(behind[: m - w + 1], ahead[w - 1 : m]) & _PLACE).astype(np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
    inside = np.flatnonzero(np.arange(len(at)) + length <= ends[owner])
    if not len(inside):
        return empty, empty, empty, empty, empty, empty
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (at[inside][1:] != at[inside][:-1]) | (owner[inside][1:] != owner[inside][:-1])
    first = np.flatnonzero(new)
    p0, p1 = inside[first], inside[np.append(first[1:], len(inside)) - 1]
    spot, text = at[p0], owner[p0]
    base = (ends - sizes)[text]
    return (
        text,
        p0 - base,
        p1 - base,
        spot - base,
        grams[spot].view(np.int64),
        substring_hash(sums, down, p0, p1 + length).view(np.int64),
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _parts(texts: list[bytes], length: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(index of the first text, offset, texts): long texts in parts that overlap by ``length - 1`` bytes."""
    for first, held in chunks(texts, FIND_BYTES):
        if sum(map(len, held)) <= 2 * PART_BYTES:
            yield first, 0, held
            continue
        for i, text in enumerate(held, first):
            for at in range(0, len(text), PART_BYTES):
                yield i, at, [text[at : at + PART_BYTES + length - 1]]


def _find(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            keys = batch.column(batch.schema.get_field_index("key"))
            (texts,) = batch_columns(batch, "text")
            for first, at, held in _parts(texts, length):
                text, p0, p1, spot, gram, piece = find_pieces(held, length, anchor)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(first + text)),
                        pa.array((at + p0).astype(np.int32)),
                        pa.array((at + p1).astype(np.int32)),
                        pa.array((at + spot).astype(np.int32)),
                        pa.array(gram),
                        pa.array(piece),
                    ],
                    names=["key", "p0", "p1", "spot", "gram", "piece"],
                )

    return run


class ColumnFiles:
    """One record per round, written and read in sequence: symbols, order and common prefixes of a column."""

    def __init__(self, folder: str):
        self.symbols, self.orders, self.commons = (open(f"{folder}/{n}", "w+b") for n in ("bwt", "order", "lcp"))
        self.columns: list[tuple[int, int]] = []

    def append(self, column: int, symbols: np.ndarray, order: np.ndarray, common: np.ndarray) -> None:
        symbols.astype(np.int16).tofile(self.symbols)
        order.astype(np.int32).tofile(self.orders)
        common.astype(np.int32).tofile(self.commons)
        self.columns.append((column, len(order)))

    def read(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for f in (self.orders, self.commons):
            f.flush()
            f.seek(0)
        for column, n in self.columns:
            yield column, np.fromfile(self.orders, np.int32, n), np.fromfile(self.commons, np.int32, n)

    def close(self) -> None:
        for f in (self.symbols, self.orders, self.commons):
            f.close()


def _insert(order: np.ndarray, common: np.ndarray, group: np.ndarray, symbol: np.ndarray, width: int):
    """One round: prepend ``symbol`` (by piece; below 0: none) to the suffix of each piece.

    ``order`` lists the pieces group by group in suffix order; ``common`` is the
    common prefix of each with the one before it (-1 at the start of a group).
    """
    said = symbol[order].astype(np.int64)  # the transform's symbols, in the last round's order
    new = np.argsort(group[order].astype(np.int64) * 1024 + said + 1, kind="stable")
    out = order[new]
    same = np.zeros(len(new), dtype=bool)
    same[1:] = (group[out][1:] == group[out][:-1]) & (said[new][1:] == said[new][:-1]) & (said[new][1:] >= 0)
    found = np.where(np.concatenate(([True], group[out][1:] != group[out][:-1])), -1, 0).astype(np.int32)
    at = np.flatnonzero(same)
    if len(at):
        # range minimum over the last round between two neighbours of the same symbol
        pairs = np.empty(2 * len(at), dtype=np.int64)
        pairs[0::2] = new[at - 1] + 1
        pairs[1::2] = new[at] + 1
        low = np.minimum.reduceat(np.append(common, np.iinfo(np.int32).max), pairs)[0::2]
        found[at] = low + width
    return out, found


def repeated_windows(group: np.ndarray, before: list[bytes], after: list[bytes], length: int, anchor: int) -> list[tuple[int, int]]:
    """(piece, offset): the windows that start ``offset`` bytes before the anchor and occur in another piece.

    ``group`` says whose anchor a piece has, ``before`` and ``after`` hold its
    bytes around the anchor.
    """
    m = len(group)
    order = np.argsort(group, kind="stable").astype(np.int32)
    common = np.where(np.concatenate(([True], group[order][1:] != group[order][:-1])), -1, 0).astype(np.int32)

    def columns(parts: list[bytes], wide: int) -> np.ndarray:
        out = np.full((wide, m), -1, dtype=np.int16)
        for i, part in enumerate(parts):
            out[: len(part), i] = np.frombuffer(part, dtype=np.uint8)
        return out

    right = columns(after, max(map(len, after), default=0))
    left = columns([x[::-1] for x in before], max(map(len, before), default=0))
    with tempfile.TemporaryDirectory() as folder:
        files = ColumnFiles(folder)
        try:
            for column in range(len(right) - 1, -1, -1):
                order, common = _insert(order, common, group, right[column], 1)
                files.append(-1 - column, right[column][order], order, common)
            same = np.full(m, 256, dtype=np.int16)
            order, common = _insert(order, common, group, same, anchor)
            files.append(0, same[order], order, common)
            for column in range(len(left)):
                order, common = _insert(order, common, group, left[column], 1)
                files.append(column + 1, left[column][order], order, common)
            out = []
            for column, ranks, shared in files.read():
                if column < 0:
                    continue
                hit = np.zeros(m, dtype=bool)
                near = np.flatnonzero(shared >= length)
                hit[near] = True
                hit[near - 1] = True
                out.extend((int(i), column) for i in ranks[hit])
            return out
        finally:
            files.close()


def _build(length: int, anchor: int):
    """Blocks of pieces, sorted by anchor -> covered spans of the single pieces, by (gram, piece)."""

    def emit(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())],
            names=["gram", "piece", "low", "high"],
        )

    def block(rows: list[tuple]) -> pa.RecordBatch:
        grams = np.array([r[0] for r in rows], dtype=np.int64)
        group = np.unique(grams, return_inverse=True)[1].astype(np.int32)
        before = [r[2][: r[3]] for r in rows]
        after = [r[2][r[3] + anchor :] for r in rows]
        spans: dict[int, list[int]] = {}
        for i, offset in repeated_windows(group, before, after, length, anchor):
            spans.setdefault(i, []).append(offset)
        out = []
        for i, offsets in spans.items():
            offsets.sort()
            low = last = offsets[0]
            for x in offsets[1:]:
                if x != last + 1:
                    out.append((rows[i][0], rows[i][1], low, last))
                    low = x
                last = x
            out.append((rows[i][0], rows[i][1], low, last))
        return emit(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*batch_columns(batch, "gram", "piece", "bytes", "lead")):
                if len(held) >= BLOCK_PIECES and row[0] != held[-1][0]:
                    yield block(held)
                    held = []
                held.append(row)
        if held:
            yield block(held)

    return run


def _windows(length: int):
    """Pieces of a very large group -> a row per window: its hash and where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, piece, data, lead in zip(*batch_columns(batch, "gram", "piece", "bytes", "lead")):
                buffer = np.frombuffer(data, dtype=np.uint8)
                sums, down = prefix_hashes(buffer)
                start = np.arange(len(buffer) - length + 1)
                found = substring_hash(sums, down, start, start + length).view(np.int64)
                n = len(start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, gram)), pa.array(np.full(n, piece)), pa.array((lead - start).astype(np.int32)), pa.array(found)],
                    names=["gram", "piece", "offset", "window"],
                )

    return run


def _slice_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the list of wanted pieces -> the pieces' bytes."""
    for batch in _slices(batches):
        rows = []
        texts, wanted = batch_columns(batch, "text", "wanted")
        for text, pieces in zip(texts, wanted):
            for p in pieces:
                rows.append((p["gram"], p["piece"], p["variants"], p["spot"] - p["p0"], text[p["p0"] : p["end"]]))
        cols = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            names=["gram", "piece", "variants", "lead", "bytes"],
        )


def repeated_spans(texts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, max_group: int = MAX_GROUP) -> DataFrame:
    """(key, spans): for each text, the start and stop of the bytes that repeated strings cover.

    ``texts`` has (key, text): every different text once, of ``length`` bytes or
    more, with ``copies``, the number of rows that hold it (null: one). Spans are sorted, disjoint and not adjacent.
    """
    every = cut(texts.select("key", "text").mapInArrow(_find(length, anchor), "key binary, p0 int, p1 int, spot int, gram long, piece long"))
    again = cut(every.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"))
    found = cut(every.join(_small(again, 40), "gram", "left_semi"))
    release(every, again)
    pieces = found.groupBy("gram", "piece").agg(F.count("*").alias("n"), F.min(F.struct("key", "p0", "p1", "spot")).alias("one"))
    pieces = cut(pieces)
    variants = pieces.groupBy("gram").agg(F.count("*").alias("variants")).filter("variants > 1")
    known = pieces.join(variants, "gram", "left").select("gram", "piece", "n", F.coalesce("variants", F.lit(1)).alias("variants"), "one")
    known = cut(known)
    release(pieces)
    # pieces with the same anchor but other bytes: these are built column by column
    wanted = known.filter("variants > 1").select(
        F.col("one.key").alias("key"),
        F.struct("gram", "piece", "variants", "one.p0", "one.spot", (F.col("one.p1") + length).alias("end")).alias("w"),
    )
    wanted = wanted.groupBy("key").agg(F.collect_list("w").alias("wanted"))
    bodies = texts.select("key", "text").join(wanted, "key").select("text", "wanted")
    bodies = cut(bodies.mapInArrow(_slice_pieces, "gram long, piece long, variants long, lead int, bytes binary"))
    usual = bodies.filter(F.col("variants") <= max_group).repartition("gram").sortWithinPartitions("gram")
    built = usual.mapInArrow(_build(length, anchor), "gram long, piece long, low int, high int")
    windows = bodies.filter(F.col("variants") > max_group).mapInArrow(_windows(length), "gram long, piece long, offset int, window long")
    twice = windows.groupBy("gram", "window").agg(F.count("*").alias("times")).filter("times > 1")
    counted = windows.join(twice, ["gram", "window"]).select("gram", "piece", F.col("offset").alias("low"), F.col("offset").alias("high"))
    # a piece that occurs twice is covered as a whole; of a single one, the windows found in another
    whole = known.filter("n > 1").select("gram", "piece", F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high"))
    marked = whole.unionAll(built.unionAll(counted).join(known.filter("n = 1").select("gram", "piece"), ["gram", "piece"]))
    # one row a piece with all its ranges (fewer than its bytes), so that the join makes one row an occurrence
    ranges = marked.groupBy("gram", "piece").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    merged = cut(ranges.mapInArrow(_merge_ranges, "gram long, piece long, ranges array<struct<low:int,high:int>>"))
    start = "coalesce(spot - r.high, p0)"
    stop = f"coalesce(spot - r.low, p1) + {length}"
    spans = found.join(merged, ["gram", "piece"]).selectExpr(
        "key", f"transform(ranges, r -> named_struct('start', {start}, 'stop', {stop})) AS spans"
    )
    # a text that several rows hold is covered as a whole
    whole_text = F.array(F.struct(F.lit(0).alias("start"), F.octet_length("text").alias("stop")))
    copies = texts.filter("copies > 1").select("key", whole_text.alias("spans"))
    spans = spans.unionAll(copies).groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    out = cut(spans.mapInArrow(_merge, "key binary, spans array<struct<start:int,stop:int>>"))
    release(found, known, bodies, merged)
    return out


def _merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The offsets of a piece's repeated windows as few ranges: overlapping and adjacent ones become one.

    A range without bounds stands for the whole piece and takes in all others.
    """
    for batch in batches:
        out = []
        for ranges in batch_columns(batch, "ranges")[0]:
            if any(r["low"] is None for r in ranges):
                out.append([{"low": None, "high": None}])
                continue
            merged: list[dict] = []
            for r in sorted(ranges, key=lambda r: r["low"]):
                if merged and r["low"] <= merged[-1]["high"] + 1:
                    merged[-1]["high"] = max(merged[-1]["high"], r["high"])
                else:
                    merged.append(dict(r))
            out.append(merged)
        kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(c)) for c in ("gram", "piece")] + [pa.array(out, kind)], names=["gram", "piece", "ranges"]
        )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        keys, lists = batch_columns(batch, "key", "spans")
        out = []
        for spans in lists:
            merged: list[dict] = []
            for s in spans:
                if merged and s["start"] <= merged[-1]["stop"]:
                    merged[-1]["stop"] = max(merged[-1]["stop"], s["stop"])
                else:
                    merged.append(dict(s))
            out.append(merged)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, kind)], names=["key", "spans"])


def keep_bytes(text: bytes, spans) -> bytes:
    """``text`` without the spans."""
    if not spans:
        return text
    parts, at = [], 0
    for s in spans:
        parts.append(text[at : s["start"]])
        at = s["stop"]
    parts.append(text[at:])
    return b"".join(parts)


def with_spans(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, max_group: int = MAX_GROUP, column: str = "removed_spans"
) -> DataFrame:
    """``docs`` with ``column``: start and stop of each removed run of bytes (null: none).

    Only ``text`` is read; a null text is empty and repeats nothing, and so does
    a text of under ``length`` bytes. Rows are told apart by their text, so
    doc_ids may be null or repeat. An input column of that name is replaced. An empty table gives an empty result.
    """
    texts, copies = _once(_long_texts(docs, length))
    spans = repeated_spans(texts, length, anchor, max_group)
    release(copies)
    return _attach(docs, spans.withColumnRenamed("spans", column))


def with_nested_spans(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, passage: int = PASSAGE, passage_anchor: int = PASSAGE // 2, max_group: int = MAX_GROUP
) -> DataFrame:
    """``docs`` with ``removed_spans``, as ``with_spans`` gives them, and ``passage_spans``, those of strings of ``passage`` bytes.

    ``passage`` is at most ``length``.
    """
    texts, copies = _once(_long_texts(docs, passage))
    spans = repeated_spans(texts, passage, passage_anchor, max_group)
    inside = spans_inside(texts, spans, length, anchor, max_group)
    release(copies)
    both = spans.withColumnRenamed("spans", "passage_spans").join(inside.withColumnRenamed("spans", "removed_spans"), "key", "left")
    both = cut(both)
    release(spans, inside)
    return _attach(docs, both)


def spans_inside(texts: DataFrame, spans: DataFrame, length: int, anchor: int, max_group: int = MAX_GROUP) -> DataFrame:
    """``repeated_spans`` of ``texts`` for a longer string, given the spans of a shorter one.

    All that a repeated string covers is inside one span of its parts, so the
    spans of ``length`` bytes or more take the place of the texts.
    """
    long = spans.select("key", F.filter("spans", lambda r: r.stop - r.start >= length).alias("spans")).filter(F.size("spans") > 0)
    runs = texts.join(_small_spans(long), "key").select("key", "text", "copies", F.explode("spans").alias("r"))
    runs = runs.selectExpr("key AS owner", "r.start AS first", "substring(text, r.start + 1, r.stop - r.start) AS text", "coalesce(copies, 1) AS n")
    runs = cut(runs.withColumn("key", _digest("text")))
    once, copies = _once(runs)
    found = repeated_spans(once, length, anchor, max_group)
    moved = "transform(spans, s -> named_struct('start', s.start + first, 'stop', s.stop + first)) AS spans"
    placed = runs.select("key", "owner", "first").join(_small_spans(found), "key").selectExpr("owner AS key", moved)
    out = cut(placed.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))
    release(runs, copies, found)
    return out


def _digest(column: str) -> Column:
    return F.unhex(F.md5(F.col(column).cast("binary")))


def _long_texts(docs: DataFrame, length: int) -> DataFrame:
    return docs.filter(F.octet_length("text") >= length).select(_digest("text").alias("key"), as_bytes("text"), F.lit(1).alias("n"))


def _once(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, text, copies) with every different text once, and the table of ``copies``, to be released.

    ``rows`` has (key, text, n); ``copies`` is the sum of ``n`` (null: one).
    """
    copies = cut(rows.groupBy("key").agg(F.sum("n").alias("copies")).filter("copies > 1"))
    marked = rows.select("key", "text").join(_small(copies, 80), "key", "left")
    # only the texts that several rows hold are shuffled for it
    return marked.filter("copies is null").unionAll(marked.filter("copies > 1").dropDuplicates(["key"])), copies


def _attach(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``spans`` (by key), which replace input columns of their names."""
    new = [c for c in spans.columns if c != "key"]
    kept = docs.select(*[c for c in docs.columns if c not in new], _digest("text").alias("__digest"))
    spans = _small_spans(spans, new).withColumnRenamed("key", "__key")
    return kept.join(spans, F.col("__digest") == F.col("__key"), "left").drop("__digest", "__key")


def _small_spans(spans: DataFrame, columns: Sequence[str] = ("spans",)) -> DataFrame:
    """Broadcast hint for a written table of spans that takes at most ``BROADCAST_BYTES`` in memory."""
    held = spans.agg(F.sum(64 + 16 * sum(F.coalesce(F.size(c), F.lit(0)) for c in columns))).first()[0] or 0
    return F.broadcast(spans) if held <= BROADCAST_BYTES else spans


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast hint for a written table that takes at most ``BROADCAST_BYTES`` in memory."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        ids, texts, lists, passages = batch_columns(batch, "doc_id", "text", "removed_spans", "passage_spans")
        rows = []
        for i, text, spans, shared in zip(ids, texts, lists, passages):
            text, shared = text or b"", shared or ()
            rest = keep_bytes(text, spans)
            kept = rest.decode("utf-8", "ignore")  # of a character that a span cuts, the rest goes with it
            digest, covered = hashlib.sha256(rest).hexdigest(), sum(s["stop"] - s["start"] for s in shared)
            rows.append((i, len(text), len(text) - len(rest), len(spans or ()), digest, kept, covered, len(shared)))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "n_passage_bytes", "n_passages"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


_SPANS = "__removed_spans"


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text without its spans; bytes of a character cut by a span go with it."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts, lists = batch_columns(batch, "text", _SPANS)
        out = [t if not spans else keep_bytes(t.encode(), spans).decode("utf-8", "ignore") for t, spans in zip(texts, lists)]
        batch = batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))
        yield batch.drop_columns([_SPANS])


def drop_repeats(docs: DataFrame, length: int = PASSAGE, anchor: int = PASSAGE // 2) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``, and ``n_chars`` brought up to date.

    Strings of ``length`` bytes are compared, by default those that a repeated
    passage of over 50 words (of three letters on average) must hold. Texts of
    which no character is left are dropped.
    """
    found = with_spans(docs, length, anchor, column=_SPANS)
    # only what has a span goes through Python
    changed = found.filter(F.col(_SPANS).isNotNull()).mapInArrow(_replace, docs.schema)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.filter(F.col(_SPANS).isNull()).select(*docs.columns).unionAll(changed.filter("text <> ''"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes by strings of ``LENGTH`` bytes, and how much of a text repeated passages of ``PASSAGE`` bytes cover."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = with_nested_spans(docs).withColumn("text", F.col("text").cast("binary"))
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
    return spans.mapInArrow(_clean, f"{columns}, n_passage_bytes long, n_passages long")
