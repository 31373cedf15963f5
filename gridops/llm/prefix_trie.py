"""The prefix trie of conversations, from ternary search trees over turn ids.

A conversation's turns are ordered by turn (null first), then role and text; null role or
text is empty. A node is a distinct sequence of the first d turns (role, text) of any
conversation, from the root (d = 0); its members are the conversations that start with it.

1. Dictionary: each distinct (role, text) gets a number, by a 256-bit digest of both, so that
   texts are read once and never shuffled (but for turns that share their place, whose order
   needs them). A conversation becomes an array of numbers.
2. Equal sequences become one, with their number, smallest member and the digest of all
   member ids. The ids of a sequence are range-partitioned, joined to runs in sorted order,
   and only runs meet, sorted, in the task that digests them as a stream: no list of a
   sequence's members is ever held.
3. The distinct sequences are range-partitioned. Each shard inserts its own, the median
   first, so that a sorted run makes balanced trees, into a ternary search tree: a node has
   the lower and higher ids of its place on its sides and the next place in the middle. An
   iterative walk then accumulates members, leaves and savings from the leaves up.
4. Nodes on a shard's first or last sequence may go on in the next shard. They are boundary
   nodes: the shard sends them, with what their finished children amount to, as two rows of
   arrays. Boundary rows of ``MERGED`` neighbouring shards are put into one tree by the same
   code; what is not on the first or last sequence of these is finished; and so on until one
   tree is left. Nodes under a boundary node learn its smallest member from a table of the
   finished boundary nodes.

A hot first turn is cut by what follows it, and a hot conversation is one sequence. A shard
holds about ``shard_turns`` turns of distinct sequences; a merge two sequences per shard.

Inputs: rows without a conversation id take no part; an empty table has no nodes; repeated
rows are repeated turns; other columns are not read. One conversation is one array of
numbers (8 bytes a turn) in a task. Sizes are UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridops.llm import common as c

#: Shards whose boundary rows are merged in one task.
MERGED = 64
#: Ids joined to one run, and the turns of distinct sequences aimed at for a shard.
RUN, SHARD_TURNS = 2000, 100_000

NONE = hashlib.sha256(b"").hexdigest()
_PER_DEPTH = ("sizes", "ends", "end_least", "members", "least", "children", "leaves", "saved")
NODE = "conv_id:long,depth:long,parent_conv_id:long,parent_row:long,n_convs:long,n_children:long,n_leaves:long,saved_tokens:long,ends_sha256:string"
#: A boundary row: a path, and for each depth from ``start`` on what is known of its node.
EDGE = "id:long,shard:long,start:long,path:array<long>,sha:array<string>," + ",".join(f"{x}:array<long>" for x in _PER_DEPTH)
#: What became of a boundary row's node: the row that has it now, or its smallest member.
MOVED = "id:long,depth:long,now:long,conv_id:long"
OUT = f"node struct<{NODE}>, edge struct<{EDGE}>, moved struct<{MOVED}>"


class Trie:
    """A ternary search tree; node 0 is the root, ``middle`` the tree of the next turns."""

    def __init__(self) -> None:
        self.turn, self.low, self.high, self.middle, self.parent, self.depth = [-1], [-1], [-1], [-1], [-1], [0]
        self.size, self.ends, self.end_least, self.sha = [0], [0], [None], [None]
        # what finished children amount to
        self.members, self.least, self.children, self.leaves, self.saved = [0], [None], [0], [0], [0]

    def _new(self, turn: int, parent: int) -> int:
        for column, value in (
            (self.turn, turn), (self.low, -1), (self.high, -1), (self.middle, -1), (self.parent, parent), (self.depth, self.depth[parent] + 1),
            (self.size, 0), (self.ends, 0), (self.end_least, None), (self.sha, None),
            (self.members, 0), (self.least, None), (self.children, 0), (self.leaves, 0), (self.saved, 0),
        ):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, path: list[int]) -> list[int]:
        """The nodes of a sequence, from the root on."""
        node, nodes = 0, [0]
        for turn in path:
            at, side = self.middle[node], self.middle
            last = node
            while at >= 0 and self.turn[at] != turn:
                last, side = at, self.low if turn < self.turn[at] else self.high
                at = side[at]
            if at < 0:
                at = self._new(turn, node)
                side[last] = at
            node = at
            nodes.append(node)
        return nodes

    def walk(self) -> list[int]:
        """All nodes, each after its parent, by a stack instead of recursion."""
        out, stack = [0], [self.middle[0]]
        while stack:
            at = stack.pop()
            if at < 0:
                continue
            out.append(at)
            stack += (self.high[at], self.middle[at], self.low[at])
        return out


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of every range before its halves."""
    stack = [(0, n)]
    while stack:
        lo, hi = stack.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            stack += ((mid + 1, hi), (lo, mid))


def _least(x: int | None, y: int | None) -> int | None:
    return y if x is None else x if y is None else min(x, y)


def _finished(trie: Trie, open_rows: list[tuple[int, list[int]]]) -> tuple[list[dict], list[int | None]]:
    """Closes all nodes that are in no open row (id, nodes of its path): their results, and
    every closed node's smallest member."""
    row_of = {node: i for i, nodes in reversed(open_rows) for node in nodes}
    least: list[int | None] = [None] * len(trie.turn)
    done: list[tuple] = []
    for x in reversed(trie.walk()):
        if x in row_of:
            continue
        n = trie.ends[x] + trie.members[x]
        least[x] = _least(trie.end_least[x], trie.least[x])
        leaves = trie.leaves[x] + (trie.children[x] == 0)
        saved = trie.saved[x] + (n - 1) * trie.size[x]
        done.append((x, n, leaves, saved))
        up = trie.parent[x]
        if up >= 0:
            trie.members[up] += n
            trie.least[up] = _least(trie.least[up], least[x])
            trie.children[up] += 1
            trie.leaves[up] += leaves
            trie.saved[up] += saved
    out = [
        {
            "conv_id": least[x], "depth": trie.depth[x],
            "parent_conv_id": least[trie.parent[x]] if x else None, "parent_row": row_of.get(trie.parent[x]),
            "n_convs": n, "n_children": trie.children[x], "n_leaves": leaves, "saved_tokens": saved,
            "ends_sha256": trie.sha[x] or NONE,
        }
        for x, n, leaves, saved in done
    ]
    return out, least


def _edges(trie: Trie, shard: int, open_rows: list[tuple[int, list[int]]]) -> list[dict]:
    """The boundary rows; a node on both is in the first."""
    out, first = [], set()
    for row, nodes in open_rows:
        new = [x for x in nodes if x not in first]
        first.update(new)
        if new:
            columns = {
                "sizes": trie.size, "ends": trie.ends, "end_least": trie.end_least, "members": trie.members, "least": trie.least,
                "children": trie.children, "leaves": trie.leaves, "saved": trie.saved, "sha": trie.sha,
            }
            known = {name: [column[x] for x in new] for name, column in columns.items()}
            out.append({"id": row, "shard": shard, "start": trie.depth[new[0]], "path": [trie.turn[x] for x in nodes[1:]], **known})
    return out


def _table(nodes: list[dict], edges: list[dict], moved: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    rows = [{"node": x} for x in nodes] + [{"edge": x} for x in edges] + [{"moved": x} for x in moved]
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _schema() -> pa.Schema:
    def fields(text: str) -> pa.DataType:
        kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
        return pa.struct([pa.field(name, kinds[kind]) for name, kind in (x.split(":") for x in text.split(","))])

    return pa.schema([("node", fields(NODE)), ("edge", fields(EDGE)), ("moved", fields(MOVED))])


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees over the sorted distinct sequences of a shard."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    trie, shard = Trie(), TaskContext.get().partitionId()
    for i in medians(len(rows)):
        row = rows[i]
        nodes = trie.insert(row["seq"])
        for x, size in zip(nodes[1:], row["sizes"], strict=True):
            trie.size[x] = size
        trie.ends[nodes[-1]], trie.end_least[nodes[-1]], trie.sha[nodes[-1]] = row["n"], row["least"], row["sha"]
    sides = [(2 * shard, trie.insert(rows[0]["seq"])), (2 * shard + 1, trie.insert(rows[-1]["seq"]))]
    nodes, _ = _finished(trie, sides)
    schema, edges = _schema(), _edges(trie, shard, sides)
    for i in range(0, len(nodes), 10_000):
        yield _table(nodes[i : i + 10_000], [], [], schema)
    yield _table([], edges, [], schema)


def _merge(level: int, last: bool) -> Callable[[tuple, pa.Table], pa.Table]:
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["id"])
        shard, trie = key[0].as_py(), Trie()
        held: list[tuple[int, int, int]] = []
        paths = {}
        for i in medians(len(rows)):
            row = rows[i]
            paths[i] = nodes = trie.insert(row["path"])
            for k, x in enumerate(nodes[row["start"] : row["start"] + len(row["sizes"])]):
                trie.size[x] = row["sizes"][k]
                trie.ends[x] += row["ends"][k]
                trie.end_least[x] = _least(trie.end_least[x], row["end_least"][k])
                trie.least[x] = _least(trie.least[x], row["least"][k])
                trie.sha[x] = trie.sha[x] or row["sha"][k]
                for name in ("members", "children", "leaves", "saved"):
                    getattr(trie, name)[x] += row[name][k]
                held.append((row["id"], row["start"] + k, x))
        base = level << 48
        sides = [] if last else [(base + 2 * shard, paths[0]), (base + 2 * shard + 1, paths[len(rows) - 1])]
        nodes, least = _finished(trie, sides)
        edges = _edges(trie, shard, sides)
        now = {x: i for i, found in reversed(sides) for x in found}
        moved = [{"id": i, "depth": d, "now": now.get(x), "conv_id": least[x]} for i, d, x in held]
        return pa.Table.from_batches([_table(nodes, edges, moved, _schema())])

    return merge


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (seq, sizes, conv_id) as runs of ids of one sequence."""
    seq, sizes, ids = None, None, []

    def run() -> pa.RecordBatch:
        row = {"seq": seq, "sizes": sizes, "least": ids[0], "n": len(ids), "ids": ",".join(map(str, ids))}
        return pa.RecordBatch.from_pylist([row], schema=pa.schema([("seq", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("least", pa.int64()), ("n", pa.int64()), ("ids", pa.string())]))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for row in batch.to_pylist():
            if ids and (row["seq"] != seq or len(ids) == RUN):
                held.append(run())
                ids = []
            seq, sizes = row["seq"], row["sizes"]
            ids.append(row["conv_id"])
            if len(held) == 500:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
    if ids:
        held.append(run())
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs as one row per sequence; the digest takes the runs as they come."""
    schema = pa.schema([("seq", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("least", pa.int64()), ("n", pa.int64()), ("sha", pa.string())])
    now, digest, out = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if now is not None and row["seq"] == now["seq"]:
                now["n"] += row["n"]
                digest.update(b",")
            else:
                if now is not None:
                    out.append({**now, "sha": digest.hexdigest()})
                now, digest = {k: row[k] for k in ("seq", "sizes", "least", "n")}, hashlib.sha256()
            digest.update(row["ids"].encode())
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if now is not None:
        out.append({**now, "sha": digest.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns as an array of (turn number of the
    dictionary, size), in order."""
    text, role = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("text", "role"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.filter("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    turns = c.written(turns, "trie-turns")
    # the order of different turns at one place takes their texts
    shared = turns.groupBy("conv_id", "turn").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b").select("conv_id", F.col("turn").alias("at"))
    shared = c.written(shared, "trie-shared")  # its size is known then, and mostly small
    tied = conversations.select(F.col("conv_id"), F.col("turn"), role.alias("role"), text.alias("text"), digest.alias("digest"))
    tied = tied.join(shared, (tied.conv_id == shared.conv_id) & tied.turn.eqNullSafe(shared.at)).select(tied.conv_id, "turn", "digest", "role", "text").distinct()
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    tied = tied.select("conv_id", F.col("turn").alias("at"), "digest", place.alias("place"))
    numbers = c.written(turns.select("digest").distinct().select("digest", F.monotonically_increasing_id().alias("number")), "trie-dictionary")
    turns = turns.join(numbers, "digest")
    ranked = turns.join(tied, (turns.conv_id == tied.conv_id) & turns.turn.eqNullSafe(tied["at"]) & (turns.digest == tied.digest), "left")
    entry = F.struct(turns.turn, F.coalesce("place", F.lit(0)).alias("place"), "number", "size")
    found = ranked.select(turns.conv_id, entry.alias("entry")).groupBy("conv_id").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    return found.select("conv_id", F.expr("transform(entries, x -> struct(x.number as number, x.size as size))").alias("turns"))


def rebuilt(own: DataFrame, group: int = 5, longest: int = 9) -> DataFrame:
    """(conv_id, turns) with the first h turns of conversation ``c - c % group`` in place of
    a conversation's own first h, h being crc32 of its number modulo ``longest``."""
    heads = own.filter(f"conv_id % {group} = 0").select(F.col("conv_id").alias("base"), F.expr(f"slice(turns, 1, {longest})").alias("head"))
    h = f"cast(crc32(cast(conv_id as string)) % {longest} as int)"
    joined = own.withColumn("base", F.expr(f"conv_id - conv_id % {group}")).join(heads, "base", "left")
    first = f"if({h} = 0 or head is null, slice(turns, 1, 0), slice(head, 1, {h}))"
    return joined.select("conv_id", F.expr(f"concat({first}, slice(turns, {h} + 1, size(turns)))").alias("turns"))


def trie(sequenced: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie over (conv_id, turns): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    c.small_batches(sequenced.sparkSession)
    flat = sequenced.select(F.expr("transform(turns, x -> x.number)").alias("seq"), F.expr("transform(turns, x -> x.size)").alias("sizes"), "conv_id")
    flat = c.written(flat, "trie-sequences")
    run = "seq array<long>, sizes array<long>, least long, n long, ids string"
    parts = _parts(flat.agg(F.sum(F.size("seq") + 1)), shard_turns)
    runs = flat.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(_runs, run)
    kinds = runs.repartition(parts, "seq").sortWithinPartitions("seq", "least").mapInArrow(_digests, "seq array<long>, sizes array<long>, least long, n long, sha string")
    kinds = c.written(kinds, "trie-kinds")
    shards = _parts(kinds.agg(F.sum(F.size("seq") + 1)), shard_turns)
    done = c.written(kinds.repartitionByRange(shards, "seq").sortWithinPartitions("seq").mapInArrow(_shard, OUT), "trie-shards")
    levels = [done]
    while shards > 1 or len(levels) == 1:
        shards = -(-shards // MERGED)
        group = F.expr(f"edge.shard div {MERGED}").alias("group")
        edges = levels[-1].filter("edge is not null").select(group, "edge.*")
        merged = edges.groupBy("group").applyInArrow(_merge(len(levels), shards == 1), OUT)
        levels.append(c.written(merged, "trie-merged"))
    # from the last level back: where a boundary node was finished, and its smallest member
    found, nodes = None, None
    for level in reversed(levels):
        here = level.filter("node is not null").select("node.*")
        known = here.filter("parent_row is null").drop("parent_row")
        if found is not None:
            under = here.filter("parent_row is not null").withColumn("at", F.col("depth") - 1).drop("parent_conv_id")
            above = found.select(F.col("id").alias("parent_row"), F.col("depth").alias("at"), F.col("conv_id").alias("parent_conv_id"))
            known = known.unionByName(under.join(above, ["parent_row", "at"]).select(*known.columns))
        nodes = known if nodes is None else nodes.unionByName(known)
        moved = level.filter("moved is not null").select("moved.*")
        direct = moved.filter("now is null").select("id", "depth", "conv_id")
        if found is not None:
            later = found.select(F.col("id").alias("now"), "depth", "conv_id")
            direct = direct.union(moved.filter("now is not null").drop("conv_id").join(later, ["now", "depth"]).select("id", "depth", "conv_id"))
        found = direct
    return nodes


def _parts(total: DataFrame, each: int) -> int:
    """Partitions of about ``each`` turns, and at least as many as Spark shuffles to."""
    spark = total.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(total.first()[0] or 0) // each))


def conversation_trie(conversations: DataFrame, group: int = 5, longest: int = 9, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(c.written(sequences(conversations), "trie-own"), group, longest), shard_turns)
