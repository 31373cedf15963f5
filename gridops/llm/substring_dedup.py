"""Removal of long word passages that an earlier document already holds.

Level-wise doubling: windows of half the wanted length are judged first, and only those
repeated in another document are extended to twice their length; windows that stay alone
go no further, so what is shuffled shrinks from level to level. At the first level it is
enough to look at the windows that have the smallest hash among the ``half + 1`` half
windows of some full window (each full window holds one, and equal full windows hold the
same), about 2 in ``half + 2`` of all. A full window survives only if its smallest half
window is repeated. Full windows are then judged exactly; a longer repeated passage is
a run of repeated full windows, so no level above can remove more words.

A word goes if a window of ``min_words`` words that covers it also starts in a document
with a smaller id, judged on the input. Of documents with the same words all but the
smallest id are known from the start and never spread. Sequences are compared by 64-bit
hashes (whole documents by SHA-256). Null texts have no words; a row with a null id neither
loses words nor takes any from others; rows of one id take nothing from each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm import common as c

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


_NONE = np.uint64((1 << 64) - 1)


def _sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (a ufunc: minimum, maximum) over each ``n`` neighbours, by doubling."""
    if len(x) < n:
        return x[:0]
    span = 1
    while span * 2 <= n:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[: len(x) - (n - span)], x[n - span :]) if span < n else x


def anchors(words: c.Words, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the half windows that stand for the full windows they are in."""
    half = min_words // 2
    reach = min_words - half  # further half windows in a full window
    at, h = words.windows(half)
    if len(at) <= reach:
        return at[:0], h[:0]
    least = _sliding(h, reach + 1, np.minimum)
    same = (words.row[at[: len(least)]] == words.row[at[reach:]]) & (at[reach:] - at[: len(least)] == reach)
    least = np.where(same, least, np.uint64(0))
    pad = np.zeros(reach, np.uint64)
    best = _sliding(np.concatenate([pad, least, pad]), reach + 1, np.maximum)
    chosen = (best == h) & (h != 0)
    return at[chosen], h[chosen]


def _parse(min_words: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in c.chunks(batch.column(2)):
                words = c.Words(data, offsets)
                at, h = anchors(words, min_words)
                cut = np.searchsorted(at, words.first)
                raw = data.tobytes()
                n = np.diff(words.first)
                shas = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                starts = [(at[a:b] - f).astype(np.int32) for a, b, f in zip(cut[:-1], cut[1:], words.first, strict=False)]
                hashes = [c.long_array(h[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(n, pa.int64()),
                        pa.array(shas),
                        pa.array(c.long_array(words.sequences())),
                        c.lists(starts, pa.int32()),
                        c.lists(hashes, pa.int64()),
                    ],
                    names=["doc_id", "th", "n_words", "sha", "seq", "at", "h"],
                )

    return run


def _extend(min_words: int):
    """Full windows whose smallest half window is repeated: (doc_id, th, h, at)."""
    half = min_words // 2

    def run(batches):
        for batch in batches:
            alive = batch.column(3)
            for lo, hi, data, offsets in c.chunks(batch.column(2)):
                words = c.Words(data, offsets)
                lives = np.zeros(len(words.start) + 1, bool)
                for r in range(lo, hi):
                    lives[words.first[r - lo] + np.asarray(alive[r].values, np.int64)] = True
                at, small = words.windows(half)
                full, h = words.windows(min_words)
                if not len(full):
                    continue
                spread = np.full(len(words.start), _NONE)  # half windows by their first word
                spread[at] = small
                least = _sliding(spread, min_words - half + 1, np.minimum)
                least_live = _sliding(np.where(lives[:-1], spread, _NONE), min_words - half + 1, np.minimum)
                keep = least[full] == least_live[full]
                full, h = full[keep], h[keep]
                row = words.row[full]
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array(c.long_array(h)),
                        pa.array((full - words.first[row]).astype(np.int32)),
                    ],
                    names=["doc_id", "th", "h", "at"],
                )

    return run


def _remove(min_words: int):
    def run(batches):
        for batch in batches:
            cover = batch.column(3)
            for lo, hi, data, offsets in c.chunks(batch.column(2)):
                words = c.Words(data, offsets, hashed=False)
                step = np.zeros(len(words.start) + 1, np.int64)
                for r in range(lo, hi):
                    at = words.first[r - lo] + np.unique(np.asarray(cover[r].values, np.int64))
                    step[at] += 1
                    step[at + min_words] -= 1
                gone = np.cumsum(step)[:-1] > 0
                raw, texts, removed = data.tobytes(), [], []
                for a, b in zip(words.first[:-1], words.first[1:], strict=True):
                    stay = np.flatnonzero(~gone[a:b]) + a
                    removed.append(int(b - a - len(stay)))
                    texts.append(b" ".join([raw[s:e] for s, e in zip(words.start[stay], words.end[stay], strict=True)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(removed, pa.int64()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                        pa.array([t.decode() for t in texts], pa.string()),
                    ],
                    names=["doc_id", "th", "n_removed", "kept_sha256", "kept_text"],
                )

    return run


def dedup_substrings(docs: DataFrame, min_words: int = 50) -> tuple[DataFrame, DataFrame]:
    """(summary, changed texts). Summary, one row per document: doc_id, th (the text's
    hash), n_words, n_removed, kept_sha256. Changed texts, one row per document that loses
    some but not all words by a window, or is a later copy: doc_id, th, kept_text (kept
    words joined by one space)."""
    if min_words < 2:
        raise ValueError("min_words must be at least 2")
    c.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), c.row_hash(F.col("text")).alias("th"), "text")
    parsed = c.written(
        rows.mapInArrow(_parse(min_words), "doc_id long, th long, n_words long, sha string, seq long, at array<int>, h array<long>"), "halves"
    )
    known = parsed.filter("doc_id IS NOT NULL")
    long_enough = known.filter(f"n_words >= {min_words}")
    firsts = long_enough.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("sha", "first")
    copies = c.written(
        long_enough.select("doc_id", "th", "sha", "n_words").join(firsts, "sha").filter("doc_id > first").select("doc_id", "th", "n_words").distinct(), "copies"
    )
    # the repeated hashes are written before they are joined: a join of two plain shuffles
    # can be split where one hash has many rows
    halves = known.select("seq", F.explode("h").alias("h")).groupBy("h").agg(F.min("seq").alias("a"), F.max("seq").alias("b"))
    repeated = c.written(halves.filter("a <> b").select("h"), "repeated")
    spots = known.select("doc_id", "th", F.inline(F.arrays_zip("at", "h"))).join(repeated, "h")
    alive = spots.groupBy("doc_id", "th").agg(F.collect_set("at").alias("alive")).join(copies, ["doc_id", "th"], "left_anti")
    level = c.written(
        rows.join(alive, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"]).select("doc_id", "th", "text", "alive"),
        "level",
    )
    full = level.mapInArrow(_extend(min_words), "doc_id long, th long, h long, at int")
    fulls = full.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = c.written(fulls.filter("first < last").select("h", "first"), "shared")
    cover = full.join(shared, "h").filter("doc_id > first").groupBy("doc_id", "th").agg(F.collect_set("at").alias("cover"))
    cut = c.written(
        level.select("doc_id", "th", "text")
        .join(cover, ["doc_id", "th"])
        .mapInArrow(_remove(min_words), "doc_id long, th long, n_removed long, kept_sha256 string, kept_text string"),
        "cut",
    )
    gone = copies.select("doc_id", "th", F.col("n_words").alias("n_removed"), F.lit(EMPTY_SHA).alias("kept_sha256"))
    changes = cut.select("doc_id", "th", "n_removed", "kept_sha256").union(gone)
    summary = (
        parsed.select("doc_id", "th", "n_words", "sha")
        .join(changes, ["doc_id", "th"], "left")
        .select("doc_id", "th", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
    )
    texts = cut.select("doc_id", "th", "kept_text").union(copies.select("doc_id", "th", F.lit("")))
    return summary, texts
