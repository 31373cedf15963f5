"""Sharding by sampled splitters: near-equal bytes, neighbours in key order together.

Records are ordered by a key (hash of the text, id, row number), so equal texts are
neighbours yet a group of any size can be cut. Splitters come from a key sample drawn in
proportion to size; they cut the order into ``RANGES`` ranges per shard. The ranges' exact
bytes are counted; a range over twice the mean is subdivided by splitters sampled inside
it, again and again until none is left that holds more than one record. Shards then take
consecutive ranges by their exact place in the byte order, so a shard's bytes are off by
at most the one range at either end.

The sample has about ``SAMPLE`` keys per range at any input size; with the ranges' counts
it is all that reaches the driver. Slots come from the ranges' row counts and a row number
inside each range, so no task holds a shard.

Size: UTF-8 bytes of the text (null: none) plus ``overhead``. Repeated rows are told apart
by their row number. Null ids and texts sort first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridops.llm import common as c

#: Ranges for each shard, and sampled keys for each range.
RANGES, SAMPLE = 64, 32

_RECORD = np.dtype([("a", ">u8"), ("b", ">u8"), ("c", ">u8")])


def _keys(h: np.ndarray, doc: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys as 24 bytes that compare like (hash, id, row number), signs kept in order."""
    out = np.empty(len(h), _RECORD)
    for name, x in zip("abc", (h, doc, row), strict=True):
        out[name] = np.asarray(x, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view("S24") if len(out) else np.zeros(0, "S24")


def _range_of(splitters):
    @F.pandas_udf("int")
    def run(h: pd.Series, doc: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters.value, _keys(h.to_numpy(), doc.to_numpy(), row.to_numpy()), side="right").astype(np.int32))

    return run


def _sample(keyed: DataFrame, step: float) -> np.ndarray:
    """Keys drawn once for every ``step`` bytes on average, by a hash and not by chance."""
    u = (F.shiftrightunsigned(F.xxhash64("h", "doc", "row"), 11) / float(1 << 53)).alias("u")
    drawn = keyed.select("h", "doc", "row", F.floor(F.col("size") / step + u).cast("int").alias("n")).filter("n > 0")
    got = drawn.toPandas()
    keys = _keys(got["h"].to_numpy(), got["doc"].to_numpy(), got["row"].to_numpy())
    return np.sort(np.repeat(keys, np.minimum(got["n"].to_numpy(), 2 * SAMPLE)))


def shard(docs: DataFrame, n_shards: int = 40, overhead: int = 16, keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns in ``keep``, by default all), size, shard and slot
    (gapless from 0 in each shard, in key order). Only kept columns are moved."""
    spark = docs.sparkSession
    key = F.struct(
        F.xxhash64("text").alias("h"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + overhead).alias("size"),
    )
    # written, so that the row number stays the same whatever is lost later
    rows = c.written(docs.select(F.struct(*(keep or docs.columns)).alias("row"), key.alias("k")), "keyed")
    keyed = rows.select("k.*")
    whole = keyed.agg(F.sum("size"), F.count("*")).first()
    total = int(whole[0] or 0)
    goal = max(1.0, total / (n_shards * RANGES))
    drawn = _sample(keyed, goal / SAMPLE) if whole[1] else np.zeros(0, "S24")
    splitters = np.unique(drawn[SAMPLE::SAMPLE])
    while True:
        place = _range_of(spark.sparkContext.broadcast(splitters))("k.h", "k.doc", "k.row")
        ranged = rows.withColumn("range", place)
        sums = ranged.groupBy("range").agg(F.sum("k.size").alias("size"), F.max("k.size").alias("most"), F.count("*").alias("n")).toPandas().sort_values("range")
        # more than a range's share beside its largest record: that can be cut
        over = sums[(sums["size"] > 2 * goal) & (sums["size"] - sums["most"] > goal)]["range"].tolist()
        if not over:
            break
        crowded = F.broadcast(spark.createDataFrame([(int(r),) for r in over], "range int"))  # not more than there are ranges
        more = _sample(ranged.join(crowded, "range", "left_semi").select("k.*"), goal / SAMPLE)
        finer = np.union1d(splitters, more[SAMPLE // 2 :: SAMPLE])
        if len(finer) == len(splitters):
            finer = np.union1d(splitters, more)
        if len(finer) == len(splitters):
            break
        splitters = finer
    size, n = sums["size"].to_numpy(np.float64), sums["n"].to_numpy(np.int64)
    middle = np.cumsum(size) - size / 2
    to = np.minimum((middle * n_shards / max(total, 1)).astype(np.int32), n_shards - 1)
    start = np.cumsum(n) - n
    first = start - start[np.searchsorted(to, to)] if len(to) else start
    table = pa.table({"range": pa.array(sums["range"].to_numpy(np.int32), pa.int32()), "shard": pa.array(to, pa.int32()), "first": pa.array(first, pa.int64())})
    shards = F.broadcast(spark.createDataFrame(table))  # a row for each range, see above
    inner = Window.partitionBy("range").orderBy("k.h", "k.doc", "k.row")
    slots = ranged.withColumn("at", F.row_number().over(inner) - 1).join(shards, "range")
    return slots.select("row", F.col("k.size").alias("size"), "shard", (F.col("first") + F.col("at")).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 40) -> None:
    """The sharded rows as Parquet, a folder for each shard, sorted by slot in each file."""
    out = shard(docs, n_shards)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
