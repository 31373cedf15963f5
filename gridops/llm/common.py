"""Helpers shared by the training-data operators: written intermediate tables, vectorised
word hashing over Arrow text columns, and connected components by star contraction.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``. Words and word windows are hashed
with 64-bit polynomials over prefix sums, so a whole batch is hashed by a few array
operations; equal word sequences always get equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.session import scratch_path

#: Text bytes hashed at once inside a task; bounds the working arrays of a task (a single
#: longer text is taken alone).
CHUNK_BYTES = 1 << 18

WORD_RE = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_P_BYTE = 0x9E3779B97F4A7C15 | 1
_P_WORD = 0xC2B2AE3D27D4EB4F | 1
_POWERS: dict[int, np.ndarray] = {}


def small_batches(spark: SparkSession) -> None:
    """Asks for Arrow batches of a few MB: whole texts are passed to Python, and a batch is
    held several times over (JVM buffers, Python, both cores of an executor)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back: cuts the
    lineage, survives lost executors, and computes what is read twice only once."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_hash(text: Column) -> Column:
    """A text's 64-bit hash; with the id it tells rows of one id but other text apart."""
    return F.xxhash64(text)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads polynomial hashes over all 64 bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        size = max(n, CHUNK_BYTES + 1)
        got = np.full(size, base % (1 << 64), np.uint64)
        got[0] = 1
        got = np.multiply.accumulate(got)
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = got
    return got[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def _ranges(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of ``values[lo:hi]`` for many ranges at once."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=total[1:])
    return (total[hi] - total[lo]) * _powers(_inverse(base), len(values) + 1)[lo]


class Words:
    """The words of some texts: ``row`` (text of each word), ``start``/``end`` (bytes in
    ``data``), ``hash``; ``first[r]:first[r + 1]`` are the words of text ``r``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashed: bool = True):
        n, rows = len(data), len(offsets) - 1
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        solid = ~_SPACE[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        self.data, self.rows = data, rows
        self.start = np.flatnonzero(solid & (~before | cut[:n]))
        self.end = np.flatnonzero(solid & (~after | cut[1:])) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.first = np.searchsorted(self.start, offsets)
        if hashed:
            values = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
            self.hash = mix(_ranges(values, self.start, self.end, _P_BYTE) + (self.end - self.start).astype(np.uint64))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each window of ``n`` words within one text."""
        at = np.arange(max(0, len(self.start) - n + 1))
        at = at[self.row[at] == self.row[at + n - 1]] if len(at) else at
        return at, mix(_ranges(self.hash, at, at + n, _P_WORD) + np.uint64(n))

    def sequences(self) -> np.ndarray:
        """A hash of each text's whole word sequence."""
        lo, hi = self.first[:-1], self.first[1:]
        return mix(_ranges(self.hash, lo, hi, _P_WORD) + (hi - lo).astype(np.uint64))


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``most`` bytes: (first row, end row, bytes, offsets). Nulls
    are empty texts; a longer text comes alone and whole."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Each text's sorted distinct ``n``-word shingle hashes; a text of fewer words is one
    shingle, a text without words has none."""
    at, hashes = words.windows(n)
    hi = np.searchsorted(at, words.first[1:])
    lo = np.searchsorted(at, words.first[:-1])
    counts = words.first[1:] - words.first[:-1]
    whole = words.sequences() if np.any((counts > 0) & (counts < n)) else None
    return [
        np.unique(hashes[a:b]) if b > a else whole[r : r + 1] if counts[r] else hashes[:0]
        for r, (a, b) in enumerate(zip(lo, hi, strict=True))
    ]


def long_array(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed longs, bit for bit."""
    return np.ascontiguousarray(values, np.uint64).view(np.int64)


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column of numpy arrays."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): (node, component), component
    the smallest node. Alternating large-star and small-star steps until nothing changes;
    a node's smallest neighbour is found by a pre-aggregated minimum, written before it is
    joined, so that the join of a hub's edges is one of two plain shuffles, which can be split.
    Each round is written to the shared folder."""

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))

    def large(e: DataFrame) -> DataFrame:
        n = both(e)
        least = written(n.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "cc-least")
        return n.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()

    def small(e: DataFrame) -> DataFrame:
        n = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
        least = written(n.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        hung = n.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return hung.union(least.select("u", "m")).filter("a <> b").distinct()

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    now = written(small(edges.filter("a <> b").select("a", "b")), "cc")
    seen = mark(now)
    while seen[0]:
        now = written(small(written(large(now), "cc-large")), "cc")
        last, seen = seen, mark(now)
        if last == seen:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.groupBy("node").agg(F.min("component").alias("component"))
