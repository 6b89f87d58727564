"""Helpers shared by the text operators: word hashing, count sketches, checkpoints.

Words are runs of bytes outside ``\\x20\\x09-\\x0D``. Word and n-gram hashes are
64-bit; they are computed for many documents at a time over one byte buffer, so
that a task holds a chunk of text and never a whole partition.
"""

from __future__ import annotations

import atexit
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.session import shared_dir

CHUNK_BYTES = 1 << 20
SKETCH_BITS = 20
SLICE_BITS = 14

_rng = np.random.RandomState(20240607)
_BYTE = np.frombuffer(_rng.bytes(8 * 256), dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ORDER = np.frombuffer(_rng.bytes(8 * 64), dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd step and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * CHUNK_BYTES)
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        for name, base in (("up", _STEP), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word of a uint8 buffer."""
    word = ~_SPACE[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate(([0], edge))
    if len(word) and word[-1]:
        edge = np.concatenate((edge, [len(word)]))
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of a uint8 buffer."""
    starts, ends = word_spans(data)
    if not len(starts):
        return starts, ends, np.zeros(0, dtype=np.uint64)
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * down[starts])


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words; empty if there are fewer."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(m, n, dtype=np.uint64)
    for k in range(n):
        out += mix(words[k : k + m] * _ORDER[k])
    return mix(out)


def chunks(texts: Iterable[bytes | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Groups of consecutive texts of about ``size`` bytes, with the index of the first."""
    first, held, total = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text or b"")
        total += len(held[-1]) + 1
        if total >= size:
            yield first, held
            first, held, total = i + 1, [], 0
    if held:
        yield first, held


def shingles(texts: list[bytes], n: int = 5, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a chunk of texts and the bounds of each text's part.

    A text of fewer than ``n`` words yields its whole word sequence as one
    shingle, a text without words none. Repeats are kept.
    """
    data = b"\n".join(texts)
    data = np.frombuffer(data.lower() if lower else data, dtype=np.uint8)
    starts, _, words = word_hashes(data)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_start = np.concatenate(([0], np.cumsum(lengths + 1)))
    bounds = np.searchsorted(starts, text_start)
    counts = np.diff(bounds)
    hashes = ngram_hashes(words, n)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    # position of each shingle's first word: the text's first word plus the index inside the text
    at = np.arange(cuts[-1]) + np.repeat(bounds[:-1] - cuts[:-1], sizes)
    out = np.zeros(cuts[-1], dtype=np.uint64)
    whole = np.repeat(counts >= n, sizes)
    out[whole] = hashes[at[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        out[cuts[i]] = ngram_hashes(words[bounds[i] : bounds[i + 1]], int(counts[i]))[0]
    return out, cuts


def distinct_sorted(hashes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort each part in place, keep its distinct values; returns values and new bounds."""
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        hashes[a:b].sort()
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[cuts[:-1][cuts[:-1] < len(hashes)]] = True
    return hashes[keep], np.concatenate(([0], np.cumsum(keep)))[cuts]


def batch_columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(name)).to_pylist() for name in names]


class Sketch:
    """Counts of 64-bit hashes in ``2**bits`` buckets: a summary of fixed size."""

    def __init__(self, bits: int = SKETCH_BITS):
        self.bits = bits
        self.counts = np.zeros(1 << bits, dtype=np.int64)

    def add(self, hashes: np.ndarray) -> None:
        mask = np.uint64(len(self.counts) - 1)
        self.counts += np.bincount((hashes & mask).astype(np.int64), minlength=len(self.counts))

    def slices(self) -> Iterator[tuple[int, bytes]]:
        size = 1 << min(SLICE_BITS, self.bits)
        for i in range(0, len(self.counts), size):
            if self.counts[i : i + size].any():
                yield i // size, self.counts[i : i + size].tobytes()


def _sum_slices(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, dtype=np.int64) for x in rows.column("data").to_pylist())
    return pa.table({"slice": pa.array([rows.column("slice")[0].as_py()], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})


def gather_sketch(slices: DataFrame, bits: int = SKETCH_BITS, fan: int = 64) -> np.ndarray:
    """Sum the ``(slice, data)`` rows of all tasks; the driver gets ``8 * 2**bits`` bytes at most.

    Summed in two levels, so that no group holds a row of every task.
    """
    schema = "slice int, data binary"
    slices = slices.select("slice", "data", F.pmod(F.xxhash64("data"), F.lit(fan)).alias("part"))
    once = slices.groupBy("slice", "part").applyInArrow(_sum_slices, schema)
    rows = once.groupBy("slice").applyInArrow(_sum_slices, schema).collect()
    size = 1 << min(SLICE_BITS, bits)
    out = np.zeros(1 << bits, dtype=np.int64)
    for row in rows:
        out[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(row["data"], dtype=np.int64)
    return out


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    The result has no lineage, so a lost executor costs nothing that came
    before, and the size of the table is known to the joins that follow. (A
    ``checkpoint()`` would cut the lineage as well, but carries the constraints
    of its plan along, which makes planning slow in loops.) ``release`` deletes
    such a table; what is left goes when the session's process ends.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "scratch")
    df.write.option("compression", "zstd").parquet(path)
    if not _scratch:
        atexit.register(_release_all)
    _scratch[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


_scratch: dict[str, SparkSession] = {}


def release(*tables: DataFrame | None) -> None:
    """Delete tables written by ``cut`` that no later read needs."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path in _scratch:
            spark = _scratch.pop(path)
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _release_all() -> None:
    for path, spark in list(_scratch.items()):
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session is gone; its shared folder is the deployment's to clear
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(name: str) -> Column:
    return F.col(name).cast("binary").alias(name)
