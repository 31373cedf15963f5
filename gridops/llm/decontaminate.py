"""Benchmark items in documents: passages within an edit distance of an item.

Texts are words, lower-cased A-Z. An item is in a text if at most ``k = share * W`` (rounded
down; ``W`` words of the item) word insertions, deletions or replacements turn it into some
passage of the text, of any length.

1. Windows. Such a passage has at most ``W + k`` words and shares at least
   ``W - q + 1 - q k`` of its q-word grams with the item: ``q`` is 3, or 1 where that bound
   would be below one (short items). Grams are marked, each with its item's length, in
   bitmaps of fixed size. Where so many marked grams for a length lie within ``W + k`` words,
   the windows of ``W`` words that start there are looked at (at a text's end they are filled
   up). This step loses nothing.
2. Search. A window is embedded by CGK: a walk copies a word and goes on to the next or
   stays, as a random bit of the step and the word says, for ``3 W`` steps, so that near
   sequences come out at a small Hamming distance. ``WALKS`` walks, each sampled
   ``SAMPLES`` times at ``PLACES`` places, give the keys under which windows meet items of
   the same length. Neighbouring windows are one run, with the keys of all of them: an
   item with words left out or put in meets some window of the run, as its ends need not be
   the window's. The tests measure the recall against a brute force over all passages.
3. Each run and item that met is verified exactly: the least edit distance of the item to
   any passage of the run's words (those up to ``k`` past its windows included).

Keys and runs meet by a shuffle join; items are never collected, and an item of which
many documents hold a copy is joined like any skewed key. Null or empty items match nothing;
nor do null or empty texts. Rows with a null id take no part. Repeated rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm import common as c

BITMAP_BITS = 24
WALKS, SAMPLES, PLACES = 8, 4, 2
#: Windows embedded at once, and the most starts of a run in item lengths.
EMBED, RUN = 4096, 4

_RUNS = "id long, th long, start int, size int, words binary, keys array<long>"


def edits(size: np.ndarray | int, share: float) -> np.ndarray:
    """Edits that an item of ``size`` words may have."""
    return np.floor(np.asarray(size) * share + 1e-9).astype(np.int64)


def gram_rule(size: int, share: float) -> tuple[int, int]:
    """(q, least): a passage near an item shares at least ``least`` q-word grams with it."""
    k = int(edits(size, share))
    three = size - 2 - 3 * k
    return (3, three) if three >= 1 else (1, max(1, size - k))


def grams(words: c.Words, q: int) -> np.ndarray:
    """For each word the hash of the ``q`` words from it; 0 where there are fewer."""
    if q == 1:
        return words.hash
    out = np.zeros(len(words.start), np.uint64)
    at, h = words.windows(q)
    out[at] = h
    return out


def _marks(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def cgk_keys(windows: np.ndarray) -> np.ndarray:
    """(windows x repeats) keys of equally long word sequences (hashes)."""
    n, size = windows.shape
    padded = np.concatenate([windows, np.zeros((n, 1), np.uint64)], axis=1)
    keys = []
    row = np.arange(n)
    for walk in range(WALKS):
        rng = np.random.default_rng(1000 * walk + size)  # the same walk for windows and items
        places = [np.sort(rng.choice(3 * size, PLACES, replace=False)) for _ in range(SAMPLES)]
        wanted = {int(p) for x in places for p in x}
        salts = rng.integers(1, 1 << 63, 3 * size, dtype=np.uint64) | np.uint64(1)
        at, seen = np.zeros(n, np.int64), {}
        for step in range(3 * size):
            word = padded[row, at]
            if step in wanted:
                seen[step] = word
            at = np.minimum(at + ((word * salts[step]) >> np.uint64(63)).astype(np.int64), size)
        for s, x in enumerate(places):
            key = np.full(n, (size << 16) + walk * SAMPLES + s, np.uint64)
            for p in x:
                key = c.mix(key * np.uint64(0x9E3779B97F4A7C15) + seen[int(p)])
            keys.append(key)
    return np.stack(keys, axis=1)


def distances(item: list[int], text: list[int], anchored: bool = False) -> Iterator[int]:
    """For each end in ``text`` the least edit distance of ``item`` to a passage that ends
    there; ``anchored``: to the passage from the text's start. Bit-parallel (Myers): a column
    of the distance table is two integers of one bit for each word of the item."""
    m, at = len(item), {}
    for i, word in enumerate(item):
        at[word] = at.get(word, 0) | 1 << i
    full, high, score = (1 << m) - 1, 1 << (m - 1), m
    more, less = full, 0
    for word in text:
        eq = at.get(word, 0)
        vertical = eq | less
        across = (((eq & more) + more) ^ more) | eq
        up, down = less | ~(across | more) & full, more & across
        score += bool(up & high) - bool(down & high)
        up, down = up << 1 | anchored, down << 1
        more, less = (down | ~(vertical | up)) & full, up & vertical & full
        yield score


def nearest(item: list[int], text: list[int], most: int) -> tuple[int, int, int] | None:
    """(distance, start, words) of the passage of ``text`` nearest to ``item``: the least distance, then
    the first end, then the length nearest to the item's; None if it is above ``most``."""
    end, best = -1, most + 1
    for j, d in enumerate(distances(item, text)):
        if d < best:
            end, best = j, d
    if end < 0:
        return None
    back = text[max(0, end + 1 - len(item) - best) : end + 1][::-1]
    lengths = [n for n, d in enumerate(distances(item[::-1], back, anchored=True), 1) if d == best]
    length = min(lengths, key=lambda n: (abs(n - len(item)), n))
    return best, end + 1 - length, length


def _filled(own: np.ndarray, start: int, size: int) -> np.ndarray:
    """``size`` words from ``start``, filled up with zeros past the text's end."""
    out = np.zeros(size, np.uint64)
    part = own[start : start + size]
    out[: len(part)] = part
    return out


def _embedded(runs_by_size):
    """Record batches of runs with the keys of their windows; by size: (id, th, first start,
    words, windows)."""
    for size, rows in runs_by_size.items():
        lo = 0
        while lo < len(rows):
            hi, n = lo, 0
            while hi < len(rows) and (hi == lo or n + len(rows[hi][4]) <= EMBED):
                n += len(rows[hi][4])
                hi += 1
            part = rows[lo:hi]
            keys = cgk_keys(np.concatenate([x[4] for x in part]))
            ends = np.cumsum([len(x[4]) for x in part])
            own = [np.unique(c.long_array(k)) for k in np.split(keys, ends[:-1])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in part], pa.int64()),
                    pa.array([x[1] for x in part], pa.int64()),
                    pa.array([x[2] for x in part], pa.int32()),
                    pa.array([size] * len(part), pa.int32()),
                    pa.array([x[3].tobytes() for x in part], pa.binary()),
                    c.lists(own, pa.int64()),
                ],
                names=["id", "th", "start", "size", "words", "keys"],
            )
            lo = hi


def _items(batches):
    for batch in batches:
        ids, ths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        by_size: dict[int, list] = {}
        for lo, hi, data, offsets in c.chunks(batch.column(2)):
            words = c.Words(data, offsets, lower=True)
            for r in range(lo, hi):
                own = words.hash[words.first[r - lo] : words.first[r - lo + 1]]
                if len(own):
                    by_size.setdefault(len(own), []).append((ids[r], ths[r], 0, own, own[None, :]))
        yield from _embedded(by_size)


def _sized_marks(h: np.ndarray, size) -> np.ndarray:
    """Marks of grams together with the length of the item they are from."""
    return _marks(c.mix(h + np.uint64(1) * np.asarray(size).astype(np.uint64)))


def _item_grams(share: float):
    """Marks of all grams, by q (kinds 1 and 3), and of grams with their item's length (0)."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in c.chunks(batch.column(0)):
                words = c.Words(data, offsets, lower=True)
                n = np.diff(words.first)[words.row]
                rule = {size: gram_rule(size, share)[0] for size in np.unique(n).tolist()}
                q_of = np.array([rule[size] for size in n.tolist()], np.int64)
                for q in (1, 3):
                    h = grams(words, q)
                    at = np.flatnonzero((q_of == q) & (h != 0))
                    for kind, marks in ((q, _marks(h[at])), (0, _sized_marks(h[at], n[at]))):
                        marks = np.unique(marks)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(marks), kind), pa.int32()), pa.array(marks)], names=["kind", "mark"])

    return run


def _starts(at: np.ndarray, least: int, reach: int, words: c.Words) -> np.ndarray:
    """Words from which a window is looked at: ``least`` of the marked places ``at`` lie within
    ``reach`` words of one text, the window starts at or before the first of them, and a
    passage that starts there still holds the last."""
    if len(at) < least:
        return at[:0]
    a, b = at[: len(at) - least + 1], at[least - 1 :]
    close = (b - a < reach) & (words.row[a] == words.row[b])
    a, b = a[close], b[close]
    first = np.maximum(b - reach + 1, words.first[words.row[a]])
    edge = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, a + 1, -1)
    return np.flatnonzero(np.cumsum(edge)[:-1] > 0)


def _windows(share: float, marks, sizes):
    """Runs of windows with enough marked grams, for each length of an item, with their keys."""

    def run(batches):
        maps = {}
        for kind, held in marks.value.items():
            maps[kind] = np.zeros(1 << BITMAP_BITS, bool)
            maps[kind][held] = True
        lengths = sizes.value
        for batch in batches:
            ids, ths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, _, data, offsets in c.chunks(batch.column(2)):
                words = c.Words(data, offsets, lower=True)
                hits = {}
                for q in {gram_rule(size, share)[0] for size in lengths}:
                    h = grams(words, q)
                    hits[q] = (h, np.flatnonzero(maps[q][_marks(h)] & (h != 0)))
                by_size: dict[int, list] = {}
                for size in lengths:
                    (q, least), k = gram_rule(size, share), int(edits(size, share))
                    h, at = hits[q]
                    at = at[maps[0][_sized_marks(h[at], size)]]
                    starts = _starts(at, least, size + k - q + 1, words)
                    if not len(starts):
                        continue
                    row = words.row[starts]
                    cut = np.flatnonzero((np.diff(starts) > 1) | (np.diff(row) > 0)) + 1
                    for near in np.split(starts, cut):
                        r = int(words.row[near[0]])
                        base, own = int(words.first[r]), words.hash[words.first[r] : words.first[r + 1]]
                        for i in range(0, len(near), RUN * size):
                            part = near[i : i + RUN * size] - base
                            first = max(0, int(part[0]) - k)
                            windows = np.stack([_filled(own, int(s), size) for s in part])
                            by_size.setdefault(size, []).append((ids[lo + r], ths[lo + r], first, own[first : int(part[-1]) + size + k], windows))
                yield from _embedded(by_size)

    return run


def _verify(share: float):
    def run(batches):
        for batch in batches:
            found: dict[tuple[bytes, bytes], tuple[int, int, int] | None] = {}
            out = []
            for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                if (a, b) not in found:
                    text, item = np.frombuffer(a, np.uint64).tolist(), np.frombuffer(b, np.uint64).tolist()
                    found[a, b] = nearest(item, text, int(edits(len(item), share)))
                out.append(found[a, b])
            near = pa.array([i for i, x in enumerate(out) if x], pa.int64())
            kept = batch.take(near)
            out = [x for x in out if x]
            starts = [s + x[1] for s, x in zip(kept.column(3).to_pylist(), out, strict=True)]
            sizes = [len(b) // 8 for b in kept.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[kept.column(i) for i in range(3)], pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array([x[0] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int32())],
                names=["doc_id", "th", "item_id", "start", "size", "distance", "words"],
            )

    return run


def find_items(docs: DataFrame, items: DataFrame, share: float = 0.2) -> DataFrame:
    """The best passage for each document (doc_id and th, the text's hash) and item near it:
    doc_id, th, item_id, start (word), item_words, passage_words, distance."""
    spark = docs.sparkSession
    c.small_batches(spark)
    known = items.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("id"), F.lit(0).cast("long").alias("th"), "text").distinct()
    embedded = c.written(known.mapInArrow(_items, _RUNS), "items")
    # not more marks than bits, not more lengths than the longest item's
    marked = known.select("text").mapInArrow(_item_grams(share), "kind int, mark long").distinct().toPandas()
    marks = {kind: marked.loc[marked["kind"] == kind, "mark"].to_numpy().astype(np.int32) for kind in (0, 1, 3)}
    sizes = [r["size"] for r in embedded.select("size").distinct().orderBy("size").collect()]
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), c.row_hash(F.col("text")).alias("th"), "text").filter("id IS NOT NULL")
    held = spark.sparkContext.broadcast(marks)
    runs = c.written(rows.mapInArrow(_windows(share, held, spark.sparkContext.broadcast(sizes)), _RUNS), "windows")
    side = embedded.select(F.col("id").alias("item_id"), "size", F.explode("keys").alias("key"))
    met = runs.select("id", "th", "start", "size", F.explode("keys").alias("key")).join(side, ["size", "key"])
    met = met.select("id", "th", "start", "size", "item_id").distinct()
    texts = met.join(runs.select("id", "th", "start", "size", "words").distinct(), ["id", "th", "start", "size"])
    texts = texts.join(embedded.select(F.col("id").alias("item_id"), "size", F.col("words").alias("item")), ["item_id", "size"])
    near = texts.select("id", "th", "item_id", "start", "words", "item").mapInArrow(
        _verify(share), "doc_id long, th long, item_id long, start int, size int, distance int, words int"
    )
    best = near.groupBy("doc_id", "th", "item_id").agg(F.min(F.struct("distance", "start", "size", "words")).alias("best"))
    return best.select("doc_id", "th", "item_id", *[F.col(f"best.{x}").alias(y) for x, y in (("start", "start"), ("size", "item_words"), ("words", "passage_words"), ("distance", "distance"))])


def drop_contaminated(docs: DataFrame, items: DataFrame, share: float = 0.2) -> DataFrame:
    """The documents in which no item is found. Extra columns pass, whatever their names."""
    found = find_items(docs, items, share).select("doc_id", "th").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), c.row_hash(F.col("text")).alias("th"))
    return rows.join(found, ["doc_id", "th"], "left_anti").select("row.*")
