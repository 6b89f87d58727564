"""Conversation prefix trie: ternary search trees per range shard, merged at their boundaries.

A conversation is the sequence of its turns, a turn being known by a 16-byte
digest of role and text. Conversations with the same sequence are one path with
a number of members, so copies never meet in one task. The paths are dealt into
shards by range of the sequence; a first turn that many share is split over
shards like any other range.

In a shard the turns are dictionary-encoded (their rank among the shard's
digests) and the paths are inserted into a ternary search tree, medians first,
which keeps it balanced: a node tells a turn, its ``lo`` and ``hi`` links lead to
sibling turns and ``eq`` to what follows. One pass over the nodes, children
before parents, accumulates members, leaves and savings. Nothing recurses.

Only nodes on the first and on the last path of a shard (its two spines) can
have a part of their subtree in another shard. Their sums leave the shard as
two rows without what hangs under the spine itself; one pass over the spines of
all shards, in order, with the open path as its state, merges them. That pass
reads two rows per shard, whatever the number of conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiontally.llm.common import batch_columns, cut, release, table

KEY = 16  # bytes of a turn's digest
SHARD_PATHS = 50_000  # paths of one tree; a partition with more holds several shards
BLOB_BYTES = 1 << 20
BROADCAST_BYTES = 64 << 20
WORDS = r"[^\x20\x09-\x0D]+"
NO_IDS = hashlib.sha256(b"").hexdigest()
ROOT = b"\0" * KEY

NODE_SCHEMA = (
    "digest binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
SPINE_SCHEMA = (
    "shard long, side int, skip int, digests array<binary>, counts array<long>, firsts array<long>, children array<long>, "
    "leaves array<long>, saved array<long>, words array<long>, ends array<string>"
)


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, words): turns numbered from 1 by ``turn`` (null first; ties by role, then text).

    Null role and text count as empty. Rows without conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("key"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
        role.alias("role"),
        text.alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return turns.withColumn("pos", F.row_number().over(order)).select("conv_id", "pos", "key", "words")


def shared_head(conv_id: Column) -> Column:
    """How many first turns a rebuilt conversation takes from its group's first one: crc32 of its decimal id, modulo 4."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(turns: DataFrame, group: int = 20) -> DataFrame:
    """Turns of every conversation c rebuilt: the first h of conversation ``c - c % group``, then c's own after its first h.

    Conversations that the group's first one has too few turns for get fewer; one may end without any turn.
    """
    ids = turns.select("conv_id").distinct()
    need = ids.withColumn("h", shared_head(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(group)))
    head = turns.filter("pos <= 3").withColumnRenamed("conv_id", "base")
    taken = need.join(head, "base").filter("pos <= h").select("conv_id", "pos", "key", "words")
    return taken.unionAll(turns.filter(F.col("pos") > shared_head(F.col("conv_id"))))


def paths(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, digest, path, words) per conversation of ``ids``; without turns the path is empty.

    ``path`` is the turns' keys in order, ``digest`` their chained digest.
    """
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "key", "words"))).alias("t"))
    rows = ids.join(lists, "conv_id", "left").select("conv_id", F.col("t.key").alias("keys"), F.col("t.words").alias("words"))
    return rows.mapInArrow(_chain, "conv_id long, digest binary, path binary, words array<long>")


def chained(digest: bytes, key: bytes) -> bytes:
    return hashlib.md5(digest + key).digest()


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys, words = batch_columns(batch, "conv_id", "keys", "words")
        digests, joined = [], []
        for k in keys:
            digest = ROOT
            for key in k or ():
                digest = chained(digest, key)
            digests.append(digest)
            joined.append(b"".join(k or ()))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        columns = (ids, digests, joined, [w or [] for w in words])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["conv_id", "digest", "path", "words"])


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv_id) -> (digest, first, n, blob): the decimal ids of a run, comma-joined."""

    def out(rows):
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["digest", "first", "n", "blob"])

    held, ids, size = None, [], 0
    for batch in batches:
        rows = []
        for digest, conv in zip(*batch_columns(batch, "digest", "conv_id")):
            if digest != held or size >= BLOB_BYTES:
                if ids:
                    rows.append((held, int(ids[0]), len(ids), ",".join(ids).encode()))
                held, ids, size = digest, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if rows:
            yield out(rows)
    if ids:
        yield out([(held, int(ids[0]), len(ids), ",".join(ids).encode())])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids by digest, in order -> (digest, conv_id, n_convs, ends_sha256)."""
    held, first, n, sha = None, 0, 0, None

    def out(rows):
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["digest", "conv_id", "n_convs", "ends"])

    for batch in batches:
        rows = []
        for digest, start, count, blob in zip(*batch_columns(batch, "digest", "first", "n", "blob")):
            if digest != held:
                if sha is not None:
                    rows.append((held, first, n, sha.hexdigest()))
                held, first, n, sha = digest, start, 0, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(blob)
            n += count
        if rows:
            yield out(rows)
    if sha is not None:
        yield out([(held, first, n, sha.hexdigest())])


def distinct_paths(seqs: DataFrame) -> DataFrame:
    """(path, words, conv_id, n_convs, ends) per distinct sequence: its smallest member, their number, the digest of their ids.

    Ids are sorted by range over (sequence, id), so that the members of one
    sequence are spread over tasks; each leaves its run of ids as blobs of 1 MB,
    which are hashed in order.
    """
    spread = seqs.select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    runs = spread.mapInArrow(_blobs, "digest binary, first long, n long, blob binary")
    runs = runs.repartition("digest").sortWithinPartitions("digest", "first")
    found = runs.mapInArrow(_members, "digest binary, conv_id long, n_convs long, ends string")
    return found.select("conv_id", "n_convs", "ends").join(seqs.select("conv_id", "path", "words"), "conv_id")


def median_order(n: int) -> list[int]:
    """0..n-1, the median of every interval before what lies on its two sides."""
    order, todo = [], [(0, n)]
    for low, high in todo:  # grows while it is read
        if low < high:
            middle = (low + high) // 2
            order.append(middle)
            todo += [(low, middle), (middle + 1, high)]
    return order


class TernaryTree:
    """A ternary search tree over sequences of small integers; node 0 is the root of the trie.

    ``up`` is a node's parent in the trie. A node is made before any node under
    it, so that descending ids visit children before parents.
    """

    def __init__(self):
        self.sym, self.lo, self.eq, self.hi, self.up = [-1], [-1], [-1], [-1], [-1]

    def _node(self, sym: int, up: int) -> int:
        self.sym.append(sym)
        self.lo.append(-1)
        self.eq.append(-1)
        self.hi.append(-1)
        self.up.append(up)
        return len(self.sym) - 1

    def insert(self, symbols: list[int]) -> list[int]:
        """Nodes of the path of ``symbols``, the root first; missing ones are made."""
        sym, lo, eq, hi = self.sym, self.lo, self.eq, self.hi
        at, walked = 0, [0]
        for s in symbols:
            links, owner, node = eq, at, eq[at]
            while node >= 0 and sym[node] != s:
                links, owner = (lo, node) if s < sym[node] else (hi, node)
                node = links[owner]
            if node < 0:
                node = self._node(s, at)
                links[owner] = node
            at = node
            walked.append(at)
        return walked


class Shard:
    """The tree of some paths in order, with the sums of its nodes."""

    def __init__(self, rows: list[tuple]):
        """``rows``: (path, words, conv_id, n_convs, ends), sorted by path."""
        keys = [[p[i : i + KEY] for i in range(0, len(p), KEY)] for p, *_ in rows]
        known = sorted({k for path in keys for k in path})
        code = {k: i for i, k in enumerate(known)}
        tree = TernaryTree()
        self.spines: list[list[int]] = [[], []]
        count: list[int] = [0]
        first: list[int] = [None]
        words: list[int] = [0]
        ends: dict[int, str] = {}
        for i in median_order(len(rows)):
            _, said, conv, n, end = rows[i]
            nodes = tree.insert([code[k] for k in keys[i]])
            for depth in range(len(nodes)):
                node = nodes[depth]
                if node == len(count):
                    count.append(0)
                    first.append(conv)
                    words.append(said[depth - 1])
                count[node] += n
                if first[node] is None or conv < first[node]:
                    first[node] = conv
            ends[nodes[-1]] = end
            if i == 0:
                self.spines[0] = nodes
            if i == len(rows) - 1:
                self.spines[1] = nodes
        size = len(count)
        self.count, self.first, self.words, self.ends, self.up = count, first, words, ends, tree.up
        self.depth, self.digest = [0] * size, [ROOT] * size
        for node in range(1, size):
            above = tree.up[node]
            self.depth[node] = self.depth[above] + 1
            self.digest[node] = chained(self.digest[above], known[tree.sym[node]])
        self.spine = set(self.spines[0]) | set(self.spines[1])
        self.children, self.leaves, self.saved = [0] * size, [0] * size, [0] * size
        for node in range(size - 1, 0, -1):
            if node in self.spine:
                continue  # what hangs under it is kept apart from the spine above it
            if self.children[node] == 0:
                self.leaves[node] = 1
            self.saved[node] += (count[node] - 1) * words[node]
            above = tree.up[node]
            self.children[above] += 1
            self.leaves[above] += self.leaves[node]
            self.saved[above] += self.saved[node]

    def inner_rows(self) -> Iterator[tuple]:
        for node in range(1, len(self.count)):
            if node not in self.spine:
                above = self.up[node]
                known = None if above in self.spine else self.first[above]
                yield (
                    self.digest[node], self.digest[above], self.first[node], self.depth[node], known, self.count[node],
                    self.children[node], self.leaves[node], self.saved[node], self.ends.get(node, NO_IDS),
                )

    def spine_rows(self, shard: int) -> Iterator[tuple]:
        left, right = self.spines
        shared = sum(a == b for a, b in zip(left, right))
        for side, nodes, skip in ((0, left, 0), (1, right, shared)):
            part = nodes[skip:]
            yield (
                shard, side, skip, [self.digest[v] for v in part], [self.count[v] for v in part], [self.first[v] for v in part],
                [self.children[v] for v in part], [self.leaves[v] for v in part], [self.saved[v] for v in part],
                [self.words[v] for v in part], [self.ends.get(v) for v in part],
            )


def _arrow(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], names=[n for n, _ in kinds])


_LONGS = pa.list_(pa.int64())
_NODE = [
    ("digest", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
]
_SPINE = [
    ("shard", pa.int64()), ("side", pa.int32()), ("skip", pa.int32()), ("digests", pa.list_(pa.binary())), ("counts", _LONGS),
    ("firsts", _LONGS), ("children", _LONGS), ("leaves", _LONGS), ("saved", _LONGS), ("words", _LONGS), ("ends", pa.list_(pa.string())),
]
_ROW_BLOCK = 20_000


def _build(shard_paths: int):
    """Sorted paths of a partition -> node rows (``digest`` set), and spine rows (``shard`` set)."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*batch_columns(batch, "path", "words", "conv_id", "n_convs", "ends"))
            while len(held) >= shard_paths:
                yield held[:shard_paths]
                held = held[shard_paths:]
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # partitions are in the order of their ranges, shards in the order of their paths
        number = TaskContext.get().partitionId() << 32
        for k, rows in enumerate(shards(batches)):
            shard = Shard(rows)
            block = []
            for row in shard.inner_rows():
                block.append((*row, *[None] * len(_SPINE)))
                if len(block) == _ROW_BLOCK:
                    yield _arrow(block, _NODE + _SPINE)
                    block = []
            block += [(*[None] * len(_NODE), *row) for row in shard.spine_rows(number + k)]
            yield _arrow(block, _NODE + _SPINE)

    return run


def _merge_spines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spine rows of all shards in order -> their merged nodes; the state is one open path."""
    opened: list[list] = []  # digest, count, first, children, leaves, saved, words, ends

    def close(down_to: int) -> Iterator[tuple]:
        while len(opened) > down_to:
            digest, count, first, children, leaves, saved, words, ends = opened.pop()
            leaves = leaves if children else 1
            depth = len(opened)
            saved += (count - 1) * words if depth else 0
            parent = None
            if opened:
                parent = opened[-1][0]
                opened[-1][3] += 1
                opened[-1][4] += leaves
                opened[-1][5] += saved
            yield (digest, parent, first, depth, None, count, children, leaves, saved, ends or NO_IDS)

    names = [name for name, _ in _SPINE]
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*batch_columns(batch, *names)):
            _, _, skip, *columns = row
            depth, same = skip, True
            for digest, count, first, children, leaves, saved, words, ends in zip(*columns):
                if same and depth < len(opened) and opened[depth][0] == digest:
                    node = opened[depth]
                    node[1] += count
                    node[2] = min(node[2], first)
                    node[3] += children
                    node[4] += leaves
                    node[5] += saved
                    node[7] = node[7] or ends
                else:
                    same = False
                    out += close(depth)
                    opened.append([digest, count, first, children, leaves, saved, words, ends])
                depth += 1
        yield _arrow(out, _NODE)
    yield _arrow(list(close(0)), _NODE)


def prefix_trie(seqs: DataFrame, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """The nodes of the trie of ``seqs`` (see :func:`paths`): one row per distinct first d turns, with their sums.

    ``parent_conv_id`` of the root is null. No conversations: no rows. One
    conversation's turns stand in one row (16 bytes each); nothing else grows
    with a group of conversations.
    """
    seqs = cut(seqs)
    ordered = distinct_paths(seqs).repartitionByRange("path").sortWithinPartitions("path")
    built = cut(ordered.mapInArrow(_build(shard_paths), f"{NODE_SCHEMA}, {SPINE_SCHEMA}"))
    release(seqs)
    spines = built.filter("shard is not null").select(*[name for name, _ in _SPINE])
    # two rows per shard: one task reads them in order
    merged = cut(spines.repartition(1).sortWithinPartitions("shard", "side").mapInArrow(_merge_spines, NODE_SCHEMA))
    inner = built.filter("digest is not null").select(*[name for name, _ in _NODE])
    above = merged.select(F.col("digest").alias("parent"), F.col("conv_id").alias("above_conv_id"))
    if merged.count() * 80 <= BROADCAST_BYTES:
        above = F.broadcast(above)
    out = inner.unionAll(merged).join(above, "parent", "left")
    return out.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are. Only conv_id, turn, role and text are read; see :func:`turns_in_order` for nulls and ties."""
    turns = cut(turns_in_order(conversations))
    return prefix_trie(paths(turns, turns.select("conv_id").distinct()))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut(turns_in_order(table(spark, sf_dir, "conversations")))
    return prefix_trie(paths(rebuilt(turns), turns.select("conv_id").distinct()))
