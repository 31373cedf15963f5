"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are dealt by id into blocks. A block's index holds one posting (member, value) for
each non-zero component, in segments by (impact level, dimension): the level is the
quantised size of the value, and segments lie in order of falling level. A batch of
queries is scored segment by segment. After each level a member's score is known but for
its postings of lower levels, whose share is at most |query| times the norm of those
components (Cauchy-Schwarz; kept for each member and level). Work on a block stops only
when this proves that few members can still be among a query's best: all of these are then
scored exactly, as integers. If nothing is proved before the last level, all postings have
been added and the scores are exact anyway.

Each block returns its best k for each query; the best of these are the result. Index rows
meet the query batches by block number: every batch is scored against every block.

Components become floor(scale * x). Rows with a null id or vector, or with null or
non-finite components, take no part; missing components of shorter vectors count 0. Equal
rows are one vector. Rows that share an id but not the vector are each a query and each a
candidate for other ids. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridops.llm import common as c

#: Vectors in an index block, queries in a batch (both on average), impact levels.
BLOCK, BATCH, LEVELS = 4096, 512, 8
#: Members that may still qualify, as a share of all, below which they are scored exactly.
RESCORE = 0.02

_PARTS = ("rows", "ids", "members", "amounts", "segments", "rest")
_INDEX = "block int, rows binary, ids binary, members binary, amounts binary, segments binary, rest binary"


def _dense(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for r, v in enumerate(vectors):
        out[r, : len(v)] = v
    return out


def build_block(rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> dict[str, bytes]:
    """The index of one block; see the module's text."""
    size = np.abs(vectors)
    level = np.minimum(size * LEVELS // (size.max(initial=0) + 1), LEVELS - 1)
    member, dim = np.nonzero(vectors)
    falling = LEVELS - 1 - level[member, dim]
    order = np.lexsort((member, dim, falling))
    member, dim, falling = member[order], dim[order], falling[order]
    first = np.flatnonzero(np.diff(falling * vectors.shape[1] + dim, prepend=-1)) if len(dim) else np.zeros(0, np.int64)
    rest = np.stack([np.sqrt(np.where(level < LEVELS - 1 - f, vectors.astype(np.float64) ** 2, 0).sum(axis=1)) for f in range(LEVELS)])
    return {
        "rows": rows.astype(np.int64).tobytes(),
        "ids": ids.astype(np.int64).tobytes(),
        "members": member.astype(np.int32).tobytes(),
        "amounts": vectors[member, dim].astype(np.int64).tobytes(),
        "segments": np.stack([falling[first], dim[first], first], axis=1).astype(np.int64).tobytes(),
        "rest": rest.tobytes(),
    }


def search_block(index: dict[str, bytes], query_rows: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, member id, score) of each query's best ``k`` in the block."""
    ids = np.frombuffer(index["ids"], np.int64)
    member, amount = np.frombuffer(index["members"], np.int32), np.frombuffer(index["amounts"], np.int64)
    segments = np.frombuffer(index["segments"], np.int64).reshape(-1, 3)
    n, q = len(ids), len(query_rows)
    rest = np.frombuffer(index["rest"], np.float64).reshape(LEVELS, n)
    width = max(queries.shape[1], int(segments[:, 1].max(initial=-1)) + 1)
    weights = np.zeros((q, width), np.int64)
    weights[:, : queries.shape[1]] = queries
    norm = np.sqrt((weights.astype(np.float64) ** 2).sum(axis=1))
    score = np.zeros((n, q), np.int64)
    own = np.frombuffer(index["rows"], np.int64)[:, None] == query_rows[None, :]
    ends = np.append(segments[1:, 2], len(member))
    at, possible = 0, ~own
    for level in range(LEVELS):
        while at < len(segments) and segments[at, 0] == level:
            _, dim, lo = segments[at]
            score[member[lo : ends[at]]] += amount[lo : ends[at], None] * weights[None, :, dim]
            at += 1
        if level == LEVELS - 1:
            break
        slack = rest[level][:, None] * norm[None, :] * (1 + 1e-9) + 1e-6
        least = np.where(own, -np.inf, score - slack)
        floor = np.partition(least, max(0, n - k), axis=0)[max(0, n - k)] if n > k else np.full(q, -np.inf)
        possible = (score + slack >= floor[None, :]) & ~own
        if possible.sum() <= max(RESCORE * n * q, 4 * k * q):
            vectors = np.zeros((n, width), np.int64)
            dims = np.repeat(segments[:, 1], ends - segments[:, 2])
            vectors[member, dims] = amount
            r, col = np.nonzero(possible)
            for lo in range(0, len(r), 1 << 14):
                part = slice(lo, lo + (1 << 14))
                score[r[part], col[part]] = (vectors[r[part]] * weights[col[part]]).sum(axis=1)
            break
    rows, found, best = [], [], []
    for j in range(q):
        r = np.flatnonzero(possible[:, j])
        if not len(r):
            continue
        s = score[r, j]
        if len(r) > k:
            keep = s >= np.partition(s, len(s) - k)[len(s) - k]
            r, s = r[keep], s[keep]
        order = np.lexsort((ids[r], -s))[:k]
        rows.append(np.full(len(order), j))
        found.append(ids[r[order]])
        best.append(s[order])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(rows or none), np.concatenate(found or none), np.concatenate(best or none)


def _build(batches):
    """Blocks from rows sorted by block."""
    block, numbers, ids, vectors = None, [], [], []

    def row() -> pa.RecordBatch:
        made = build_block(np.array(numbers, np.int64), np.array(ids, np.int64), _dense(vectors))
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *[pa.array([made[x]], pa.binary()) for x in _PARTS]], names=["block", *_PARTS])

    for batch in batches:
        for b, r, i, v in zip(*(batch.column(x).to_pylist() for x in range(4)), strict=True):
            if b != block:
                if ids:
                    yield row()
                block, numbers, ids, vectors = b, [], [], []
            numbers.append(r)
            ids.append(i)
            vectors.append(v)
    if ids:
        yield row()


def _search(k: int):
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                index = {x: batch.column(x)[r].as_buffer() for x in _PARTS}
                queries = batch.column("queries")[r].as_py()
                qid = np.array([x["vec_id"] for x in queries], np.int64)
                numbers = np.array([x["row"] for x in queries], np.int64)
                at, found, score = search_block(index, numbers, _dense([x["v"] for x in queries]), k)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (qid[at], numbers[at], found, score)], names=["query_id", "row", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """Best ``k`` other rows for each row whose vec_id is divisible by ``every``: query_id,
    rank, vec_id, score."""
    fine = "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    rows = vectors.filter(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v")
    )
    # written once, so that a row keeps its number
    rows = c.written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, wanted = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    blocks, lots = max(1, -(-n // BLOCK)), max(1, -(-wanted // BATCH))
    placed = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), "row", "vec_id", "v")
    index = c.written(placed.repartition("block").sortWithinPartitions("block", "vec_id").mapInArrow(_build, _INDEX), "impact-index")
    queries = rows.filter(F.col("vec_id") % every == 0).withColumn("lot", F.pmod(F.xxhash64("row"), F.lit(lots)))
    queries = queries.groupBy("lot").agg(F.collect_list(F.struct("vec_id", "row", "v")).alias("queries"))
    sent = queries.select("queries", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    best = index.hint("shuffle_hash").join(sent, "block").mapInArrow(_search(k), "query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
