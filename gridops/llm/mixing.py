"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source has a size (words) and a target: weights share the whole size out, no target
exceeds ``max_repeats`` times its source, and what is cut off goes to the others by weight.
A source's documents, in a pseudo-random order and
repeated end to end, are one stream of words cut into blocks of one common length; its
target is a quota of blocks, the last one a part: of it the documents are taken whose middle
lies before the target, so a source comes within half a document of its target however many
sources there are. If the target ends in the first document, that one is taken with the
chance that keeps the mean. The tree starts with the multiset of all quotas and
deals each node's blocks to its two halves of the output shards by drawing exactly the
left half's share without replacement, so the sources' counts in each half follow the
multivariate hypergeometric law; every shard gets blocks in proportion, a few apart at most.
A document is drawn, into that shard, if the tree dealt its block.
There are ``shards * blocks_per_shard`` blocks, and at most one more per source, at any
input size, so the tree is small. Documents find their place in the stream by two prefix
sums (buckets of a source, rows of a bucket), so a source that holds most rows is never in
one task. A shard's order is a pseudo-random key per drawn copy.

DataFrame functions only. Results depend on rows alone (ids, texts), so reruns agree.
Null texts have no words: they are drawn or not with the block they fall into and add no
words. A null source is a source, last in order. Equal rows are drawn each by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridops.llm import common as c
from gridops.operators.ids import append_ids


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """``sizes`` (key, source, source_size) with total, cap and ``target``; a row per source.

    Sources are numbered in order by a distributed sort. The level is found as the definition
    says: what capped sources leave is shared by weight among the others until none of them
    is above its cap; a round is one sum over the sources."""
    numbered = append_ids(sizes, [F.col("source").isNull(), "source"], "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = numbered.select(
        "key", "source", "source_size",
        F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (max_repeats * F.col("source_size")).alias("cap"),
    )
    ranked = c.written(ranked, "mix-weights")
    total, level, capped = ranked.agg(F.sum("source_size")).first()[0] or 0, 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        n, full, free = ranked.agg(F.count_if(over), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))).first()
        if n == capped or not free:
            break
        capped, level = n, (total - (full or 0)) / free
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    return ranked.select("key", "source", "source_size", F.lit(float(total)).alias("total"), F.col("cap").cast("double").alias("cap"), target.alias("target"))


#: Blocks of a node that one task ranks, on average.
RANKED = 50_000


def splitting_tree(quotas: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``quotas`` (key, quota) dealt to shards: (key, block, shard). Each node's blocks are
    put in a random order and the first, in proportion to the left half's shards, go left.
    A block's rank is the number of blocks in the buckets of random keys before its own, plus
    its rank there, so a node is never in one task, however many sources there are."""
    blocks = quotas.filter("quota > 0").select("key", F.explode(F.sequence(F.lit(0), (F.col("quota") - 1).cast("int"))).alias("block"))
    node = c.written(blocks.withColumns({"lo": F.lit(0), "hi": F.lit(shards)}), "mix-node")
    bits = max(0, (node.count() // RANKED).bit_length())
    widest, depth = shards, 0
    while widest > 1:
        at = F.shiftrightunsigned(F.xxhash64("key", "block", F.lit(seed), F.lit(depth)), 1)
        node = node.withColumns({"at": at, "bucket": F.shiftright(at, 63 - bits), "mid": F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")})
        buckets = node.groupBy("lo", "hi", "bucket").agg(F.count("*").alias("n"))
        inside = Window.partitionBy("lo", "hi")
        earlier = inside.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        buckets = buckets.select("lo", "hi", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(inside).alias("whole"))
        drawn = Window.partitionBy("lo", "hi", "bucket").orderBy("at", "key", "block")
        node = node.withColumn("rank", F.row_number().over(drawn)).join(buckets, ["lo", "hi", "bucket"])
        left = F.floor(F.col("whole") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo")))
        goes = (F.col("mid") > F.col("lo")) & (F.col("before") + F.col("rank") <= left)
        node = node.select(
            "key", "block",
            F.when(goes | (F.col("mid") == F.col("lo")), F.col("lo")).otherwise(F.col("mid")).alias("lo"),
            F.when(goes, F.col("mid")).otherwise(F.col("hi")).alias("hi"),
        )
        node = c.written(node, "mix-node")
        widest, depth = (widest + 1) // 2, depth + 1
    return node.select("key", "block", F.col("lo").alias("shard"))


def mix_plan(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    max_repeats: int = 3,
    shards: int = 40,
    blocks_per_shard: int = 1024,
    seed: int = 0,
    keep: list[str] | None = None,
) -> DataFrame:
    """A row per document: ``row`` (a struct of the columns in ``keep``, by default all),
    size, source_size, target, and ``draws``, an array of (repeat, block, shard, place), one
    for each copy that the mix takes."""
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    order = F.xxhash64("doc_id", "text", F.lit(seed))
    n_buckets = 1 << (max(64, min(1 << 16, docs.count() // 512)) - 1).bit_length()
    rows = docs.select(
        F.struct(*(keep or docs.columns)).alias("row"),
        F.col("source").cast("string").alias("source"),
        key.alias("key"),
        order.alias("at"),
        F.shiftrightunsigned(order, 64 - (n_buckets.bit_length() - 1)).cast("int").alias("bucket"),
        F.coalesce(F.regexp_count("text", F.lit(c.WORD_RE)), F.lit(0)).cast("long").alias("size"),
    )
    sums = c.written(rows.groupBy("key", "bucket").agg(F.min("source").alias("source"), F.sum("size").alias("words")), "mix-buckets")
    sources = targets(sums.groupBy("key").agg(F.min("source").alias("source"), F.sum("words").alias("source_size")), weights, max_repeats)
    length = F.greatest(F.lit(1.0), F.col("total") / (shards * blocks_per_shard))
    sources = sources.withColumn("length", length)
    # a source's last block is a part: which documents of it are taken, their words say
    quota = F.ceil(F.col("target") / F.col("length"))
    sources = c.written(sources.withColumn("quota", quota.cast("long")), "mix-sources")
    dealt = splitting_tree(sources.select("key", "quota"), shards, seed).groupBy("key")
    dealt = dealt.agg(F.sort_array(F.collect_list(F.struct("block", "shard"))).alias("dealt"))
    sources = sources.join(dealt, "key", "left").withColumn("dealt", F.expr("transform(coalesce(dealt, array()), x -> x.shard)"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    places = sums.select("key", "bucket", "words", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")).join(sources.drop("source"), "key")
    # the part of the source's block list that a bucket's rows can fall into, for each repeat
    first = "cast(greatest(0, least(quota - 1, floor((e * source_size + offset) / length))) as int)"
    part = f"""transform(sequence(0, {max_repeats - 1}), e -> struct({first} as first,
        slice(dealt, {first} + 1, cast(floor((e * source_size + offset + words) / length) as int) - {first} + 1) as shards))"""
    places = places.select("key", "bucket", "offset", "source_size", "target", "cap", "length", "quota", F.expr(part).alias("parts"))
    inner = Window.partitionBy("key", "bucket").orderBy("at", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(places, ["key", "bucket"])
    # a document is drawn with the block that the tree dealt. Of a source's last block, unless
    # it is taken to its cap, those are drawn whose middle is before the target; if that is in
    # the first document, it is drawn with the chance that keeps the mean
    chance = f"pmod(xxhash64(key, {seed}, 'rest'), 1048576) / 1048576D * size < target"
    block = f"""transform(sequence(0, {max_repeats - 1}), e -> struct(e as repeat, e * source_size + offset + before as start,
        cast(least(quota - 1, floor((e * source_size + offset + before + size / 2) / length)) as int) as block))"""
    taken = f"quota > 0 and case when target >= cap then true when x.start = 0 and size > target then {chance} else x.start + size / 2 < target end"
    draws = f"""filter(transform(filter({block}, x -> {taken}), x -> struct(x.repeat as repeat, x.block as block,
        try_element_at(parts[x.repeat].shards, x.block - parts[x.repeat].first + 1) as shard, xxhash64(at, x.repeat, {seed}) as place)), x -> x.shard is not null)"""
    return rows.select("row", "size", "source_size", "target", F.expr(draws).alias("draws"))


def mixed(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: ``row`` (a document's columns), once for each copy taken, its output
    shard and its random place there, by which a shard is ordered."""
    plan = mix_plan(docs, **params)
    return plan.select("row", F.explode("draws").alias("draw")).select("row", F.col("draw.shard").alias("shard"), F.col("draw.place").alias("place"))
