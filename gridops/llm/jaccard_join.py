"""Exact Jaccard join of documents on word shingles, as a metric-space join.

The Jaccard distance d(x, y) = 1 - |x & y| / |x | y| is a metric, and documents link at
d <= t = 1 - percent / 100. Two levels of Voronoi regions with triangle-inequality windows:

1. Pivots are single shingles. A document's cell is that of its first shingle in one
   global order (shingles of rarely hit count buckets first). For P, the first k shingles
   of x, d(x, P) = 1 - k / |x|; a partner y has d(y, P) <= t + 1 - k / |x|, which is below
   1 -- so y shares a shingle with P -- once k > t |x|. Hence x is replicated to the cells
   of its first ``|x| - ceil((1 - t) |x|) + 1`` shingles, and any linked pair meets.
2. Each cell names its smallest member as pivot document; documents that share a pivot
   form its region (a document is sent there once, whatever the number of shared cells).
   First only parity bitmaps meet: each shingle flips one bit, so bitmaps of x and y differ
   in at most |x ^ y| bits, and a member whose bitmap is too far from all others' has no
   link there. The texts of the others follow. Balls of radius t are drawn around pivots
   until all members lie in one; only members of a ball within 2 t of another ball's pivot
   are replicated to that ball and compared with it, and balls already connected are left
   alone. Regions over ``BLOCK`` members are joined as pairs of blocks, so no task holds a
   region whole.

Links come out as a spanning forest per region, so copies never become all pairs, and the
components are exact. Equal sets are one class from the start.

Nulls and texts without words have an empty set and link with nothing; a null id takes no
part (its component is null). Repeated rows and rows of one id with other texts are told
apart by the text's hash, and links and components are between classes, so each text of an
id has its own component; every input row gives one output row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridops.llm import common as c

#: Counters of the shingle count table (fixed size at any input).
BUCKETS = 1 << 19
#: A bucket is heavy from this multiple of the mean load; so at most BUCKETS / HEAVY are.
HEAVY = 4
#: Members of a region that one task compares at once, at most twice this many.
BLOCK = 1024

_PARSED = "doc_id long, th long, n long, k1 long, k2 long, prefix array<long>, bits binary"


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 19)).astype(np.int64)


def _count(words: int):
    def run(batches):
        load = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, data, offsets in c.chunks(batch.column(0)):
                load += np.bincount(_bucket(c.Words(data, offsets, lower=True).windows(words)[1]), minlength=BUCKETS)
        at = np.flatnonzero(load)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(load[at], pa.int64())], names=["bucket", "load"])

    return run


def heavy_buckets(texts: DataFrame, words: int) -> np.ndarray:
    """Order levels of the count buckets over all documents: 0, or from 1 for buckets with
    at least HEAVY times the mean load. At most BUCKETS / HEAVY rows reach the driver."""
    loads = texts.mapInArrow(_count(words), "bucket long, load long").groupBy("bucket").agg(F.sum("load").alias("load"))
    loads = c.written(loads, "loads")
    mean = max(1.0, (loads.agg(F.sum("load")).first()[0] or 0) / BUCKETS)
    level = np.zeros(BUCKETS, np.uint8)
    for r in loads.filter(F.col("load") >= HEAVY * mean).collect():
        level[r["bucket"]] = 1 + int(np.log2(r["load"] / mean))
    return level


def _parity(items: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set: a power of two of bits, not fewer than the set's size."""
    n = max(64, 1 << (len(items) - 1).bit_length())
    odd = np.bincount((items & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _parse(words: int, percent: int, levels):
    def run(batches):
        level = levels.value
        for batch in batches:
            ids, th = batch.column(0), batch.column(1)
            for lo, hi, data, offsets in c.chunks(batch.column(2)):
                n, k1, k2, prefix, bits = [], [], [], [], []
                for items in c.shingle_sets(c.Words(data, offsets, lower=True), words):
                    size = len(items)
                    n.append(size)
                    with np.errstate(over="ignore"):
                        k1.append(c.mix(items).sum(dtype=np.uint64) if size else np.uint64(0))
                        k2.append(c.mix(items ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) if size else np.uint64(0))
                    k = size - (percent * size + 99) // 100 + 1 if size else 0
                    order = np.argsort(level[_bucket(items)], kind="stable")[:k]
                    prefix.append(c.long_array(items[order]))
                    bits.append(_parity(items).tobytes() if size else b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        th.slice(lo, hi - lo),
                        pa.array(n, pa.int64()),
                        pa.array(c.long_array(np.array(k1, np.uint64))),
                        pa.array(c.long_array(np.array(k2, np.uint64))),
                        c.lists(prefix, pa.int64()),
                        pa.array(bits, pa.binary()),
                    ],
                    names=["doc_id", "th", "n", "k1", "k2", "prefix", "bits"],
                )

    return run


def near_some(sizes: np.ndarray, bits: list[np.ndarray], percent: int) -> np.ndarray:
    """Which members' bitmaps allow a link with some other member."""
    near = np.zeros(len(bits), bool)
    width = np.array([len(x) for x in bits])
    for w in np.unique(width):  # linked sets have bitmaps of one width or of w and 2 w
        at = np.flatnonzero((width == w) | (width == 2 * w))
        if len(at) < 2:
            continue
        folded = np.stack([bits[i] if len(bits[i]) == w else bits[i][:w] ^ bits[i][w:] for i in at])
        size = sizes[at]
        for r in range(len(at)):
            apart = np.maximum(np.bitwise_count(folded ^ folded[r]).sum(axis=1, dtype=np.int64), np.abs(size - size[r]))
            fits = (100 + percent) * apart <= (100 - percent) * (size + size[r])
            fits[r] = False
            near[at[r]] |= fits.any()
    return near


def _groups(batches, read):
    """Regions and block pairs one at a time, from rows sorted by these: (region, members),
    ``read`` gives the members of a batch and the first four columns are region, i, j, rep."""
    key, members = None, []
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in range(4)]
        for now, rep, member in zip(zip(*cols[:3], strict=True), cols[3], read(batch), strict=True):
            if now != key:
                if len(members) > 1:
                    yield key[0], members
                key, members = now, []
            if not members or members[-1][0] != rep:
                members.append((rep, member))
    if len(members) > 1:
        yield key[0], members


def _two_longs(pairs: list[tuple[int, int]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.int64()) for k in (0, 1)], names=names)


def _hopeful(percent: int):
    """Members (p, rep) of regions whose bitmaps allow a link there, and the pivots."""

    def read(batch):
        return list(zip(batch.column(4).to_pylist(), [np.frombuffer(x, np.uint64) for x in batch.column(5).to_pylist()], strict=True))

    def run(batches):
        out: list[tuple[int, int]] = []
        for p, members in _groups(batches, read):
            near = near_some(np.array([m[0] for _, m in members]), [m[1] for _, m in members], percent)
            out += [(p, members[r][0]) for r in np.flatnonzero(near)]
            if len(out) > 5000:
                yield _two_longs(out, ["p", "rep"])
                out = []
        yield _two_longs(out, ["p", "rep"])

    return run


def _join_regions(words: int, percent: int):
    """Links (a, b) of the regions' members, from their texts."""

    def read(batch):
        return [x for _, _, data, offsets in c.chunks(batch.column(4)) for x in c.shingle_sets(c.Words(data, offsets, lower=True), words)]

    def run(batches):
        out: list[tuple[int, int]] = []
        for _, members in _groups(batches, read):
            out += region_links([rep for rep, _ in members], [x for _, x in members], percent)
            if len(out) > 5000:
                yield _two_longs(out, ["a", "b"])
                out = []
        yield _two_longs(out, ["a", "b"])

    return run


def _placed(members: DataFrame, carried: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Rows (p, i, j, rep, columns) sorted by region and block pair: each member of a region
    goes to every pair of blocks that its own block is in."""
    # only regions of several blocks, written before they are joined: mostly few, and else a
    # join of two plain shuffles, which can be split where one region has many members
    blocks = members.groupBy("p").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("blocks > 1")
    blocks = c.written(blocks, "blocks")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    homes = members.join(blocks, "p", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("mine", mine)
    sent = homes.join(carried, on).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select("p", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rep", *columns)
    return sent.repartition("p", "i", "j").sortWithinPartitions("p", "i", "j", "rep")


def region_links(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the members of one region; the smallest
    class key comes first and is the first pivot. Exact: see the module's text."""
    m = len(ids)
    size = np.array([len(s) for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    _, item = np.unique(flat, return_inverse=True)
    order = np.argsort(item, kind="stable")
    start = np.searchsorted(item[order], np.arange(item.max() + 2))
    holders, first = owner[order], np.concatenate([[0], np.cumsum(size)])
    far = 1 - percent / 100
    parent = list(range(m))
    forest: list[tuple[int, int]] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x: int, y: int) -> None:
        a, b = root(x), root(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
            forest.append((ids[x], ids[y]))

    def against(x: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances of x to all members, and which of them link with it."""
        own = item[first[x] : first[x + 1]]
        lo, hi = start[own], start[own + 1]
        n = hi - lo
        at = np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())
        both = np.bincount(holders[at], minlength=m)
        either = size + size[x] - both
        return 1 - both / either, 100 * both >= percent * either

    inside = np.zeros(m, bool)
    away: dict[int, np.ndarray] = {}
    for p in range(m):
        if not inside[p]:
            away[p], near = against(p)
            inside |= near
            for y in np.flatnonzero(near):
                join(p, int(y))
    pivots, distance = list(away), np.stack(list(away.values()))
    for x in np.flatnonzero(distance.min(axis=0) > 0):  # pivots have met everyone
        other = np.flatnonzero(distance[:, x] <= 2 * far + 1e-9)
        if any(root(pivots[q]) != root(int(x)) for q in other):
            for y in np.flatnonzero(against(int(x))[1]):
                join(int(x), int(y))
    return forest


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, th (the text's hash), n_shingles, component_id (the
    smallest doc_id that links of ``words``-word shingle sets with Jaccard similarity of
    ``percent`` / 100 or more reach), component_th (the hash of the text that names the
    component, the smallest of that id there)."""
    spark = docs.sparkSession
    c.small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), c.row_hash(F.col("text")).alias("th"), "text")
    levels = spark.sparkContext.broadcast(heavy_buckets(rows.select("text"), words))
    parsed = c.written(rows.mapInArrow(_parse(words, percent, levels), _PARSED), "shingled")
    own = parsed.filter("n > 0 AND doc_id IS NOT NULL")
    # a class is known by a hash of its key, as one id may have rows in several classes
    classes = own.groupBy("k1", "k2", "n").agg(F.min(F.struct("doc_id", "th")).alias("head"))
    classes = c.written(classes.select("k1", "k2", "n", F.xxhash64("k1", "k2", "n").alias("rep"), "head"), "classes")
    heads = classes.select("k1", "k2", "n", "rep", F.col("head.doc_id").alias("doc_id"), F.col("head.th").alias("th"))
    reps = own.join(heads, ["k1", "k2", "n", "doc_id", "th"]).select("rep", "doc_id", "th", "n", "prefix", "bits")
    cell = reps.select("rep", F.explode("prefix").alias("key"))
    pivots = cell.groupBy("key").agg(F.min("rep").alias("p"), F.max("rep").alias("last")).filter("p < last").select("key", "p")
    pivots = c.written(pivots, "pivots")  # as above: the join of a frequent key can be split
    pairs = c.written(cell.join(pivots, "key").select("p", "rep").distinct(), "regions")
    met = _placed(pairs, reps.select("rep", "n", "bits").distinct(), ["rep"], ["n", "bits"])
    hopeful = c.written(met.mapInArrow(_hopeful(percent), "p long, rep long").distinct(), "hopeful")
    texts = rows.join(heads.join(hopeful.select("rep").distinct(), "rep").select("rep", "doc_id", "th"), ["doc_id", "th"])
    links = c.written(_placed(hopeful, texts.select("rep", "text"), ["rep"], ["text"]).mapInArrow(_join_regions(words, percent), "a long, b long"), "links")
    found = c.components(links)
    found = c.written(found, "components")
    nodes = found.union(found.select("component", "component").distinct())
    joined = c.written(classes.join(nodes, classes["rep"] == nodes["node"]).select("rep", "component", "head"), "joined")
    least = joined.groupBy("component").agg(F.min("head").alias("least"))
    linked = joined.join(least, "component").select("rep", "least")
    named = classes.join(linked, "rep", "left").select("k1", "k2", "n", F.coalesce("least", "head").alias("head"))
    worded = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return parsed.join(named, ["k1", "k2", "n"], "left").select(
        "doc_id", "th", F.col("n").alias("n_shingles"),
        F.when(worded, F.col("head.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(worded, F.col("head.th")).alias("component_th"),
    )


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each component the row whose id names it (of rows
    with equal id and text the one whose other columns hash lowest); documents without words,
    or without an id, stay as they are. Extra columns pass, whatever their names."""
    found = jaccard_components(docs, words, percent)
    keep = found.filter("n_shingles > 0 AND doc_id = component_id AND th = component_th").select("doc_id", "th").distinct()
    rest = F.xxhash64(F.to_json(F.struct(*[x for x in docs.columns if x.lower() != "text"])))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), c.row_hash(F.col("text")).alias("th"), rest.alias("rest"))
    one = rows.join(keep, ["doc_id", "th"]).groupBy("doc_id", "th").agg(F.min_by("row", "rest").alias("row"))
    wordless = rows.filter(F.col("doc_id").isNull() | F.col("row.text").isNull() | ~F.col("row.text").rlike(r"[^\x20\x09-\x0D]"))
    return one.select("row.*").union(wordless.select("row.*"))
