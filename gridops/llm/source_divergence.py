"""Divergence of every source of a language from the others, on a three-dimensional cube.

Terms are runs of ASCII letters (A-Z lower-cased) and characters beyond ASCII. A language
keeps the V terms found in at least ``min_docs`` of its documents (rows). A group is a
(lang, source) that occurs, and a language is one too; a group with ``count`` occurrences of
a kept term and N of all kept terms gives it ``p = 1 + floor(10^9 * (count + 1) / (N + V))``,
and p against q costs ``f = floor((p - q)^2 / q)``. All arithmetic is on whole numbers.

The pairs of a language's sources and its terms form a cube: (source blocks) x (source
blocks) x (term blocks), blocks dealt by hashes so that a source holds about
``group_block`` sources or ``term_block`` terms. A task owns the cell (a, b, t), a <= b: it gets the two slices (a, t) and
(b, t), fills in the terms that a group lacks, and computes both directions of each pair of
its groups. Terms of the block that none of its groups has are counted, not sent. A slice is
sent once to each of its language's source blocks; the cells are summed along the term axis.
A cell holds at most two blocks of groups by one block of terms, whatever a source or a term
weighs, since counts are summed per (lang, source, term) before.

Inputs: null text, lang and source are empty; groups without terms take part; repeated rows
count each; a language without kept terms gives value 0 for its pairs; an empty table gives
no rows. Only ``text``, ``lang`` and ``source`` are read, so other columns cannot clash. A
long text is one array of words in a task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridops.llm import common as c

#: The term pattern on UTF-8 bytes that are lower-cased already.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Distinct (group, term) counters a task holds before it sends them on.
HELD = 1_000_000
SCALE = 1_000_000_000

COUNTS = "lang string, source string, term string, n long, docs long"
CELLS = "lang string, source string, item string, part long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term of each group, added up within the task. Each
    group has a row with the empty term, so groups without terms are kept."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            rows = len(terms) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * rows, pa.string()),
                    pa.array([source] * rows, pa.string()),
                    pa.array([b"", *terms], pa.binary()).cast(pa.string()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *(docs[t] for t in terms)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, text in enumerate(batch.column(2).cast(pa.binary())):
            n, docs = held.setdefault((langs[i], sources[i]), (Counter(), Counter()))
            words = _TERM.findall(text.as_py().translate(_LOWER))
            n.update(words)
            docs.update(set(words))
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from sent()
    yield from sent()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs); the row with the empty term stands for its group."""
    c.small_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("lang", "source", "text")])
    found = rows.mapInArrow(_counted, COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str) -> Column:
    """``1 + floor(10^9 * (count + 1) / (total + v))``, exact for any counts."""
    return F.expr(f"1 + cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0)) div cast({total} + v as decimal(20,0))")


def _cell(key: tuple, cell: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of a cell, over the terms of its block."""
    lang, a, b, _ = (k.as_py() for k in key)
    is_group = pc.is_null(cell["term"])
    groups, entries = cell.filter(is_group), cell.filter(pc.invert(is_group))
    names = groups["source"].to_pylist()
    place = {name: i for i, name in enumerate(names)}
    block, least = np.array(groups["block"]), np.array(groups["p"])
    terms = entries["term"].combine_chunks().dictionary_encode()
    n_terms = len(terms.dictionary)
    p = np.repeat(least[:, None], n_terms, axis=1)
    p[[place[s] for s in entries["source"].to_pylist()], np.array(terms.indices)] = np.array(entries["p"])
    unseen = groups["in_block"][0].as_py() - n_terms

    def costs(x: int, others: np.ndarray) -> np.ndarray:
        q, q0 = p[others], least[others]
        return ((p[x] - q) ** 2 // q).sum(axis=1) + unseen * ((least[x] - q0) ** 2 // q0)

    left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
    sources, items, parts = [], [], []
    for mine, others in ((left, right),) if a == b else ((left, right), (right, left)):
        for x in mine:
            y = others[others != x]
            sources += [names[x]] * len(y)
            items += [names[i] for i in y]
            parts.append(costs(x, y))
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.table({"lang": pa.array([lang] * len(items), pa.string()), "source": pa.array(sources, pa.string()), "item": pa.array(items, pa.string()), "part": pa.array(values, pa.int64())})


def divergences(docs: DataFrame, min_docs: int = 3, top_terms: int = 200, group_block: int = 16, term_block: int = 2048) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` holds the cost of a source
    against each other source of its language, part ``term`` the ``top_terms`` terms that it
    has oftener than the language, by their cost against the language."""
    counts = c.written(term_counts(docs), "divergence-counts")
    vocabulary = counts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    vocabulary = c.written(vocabulary.filter(F.col("docs") >= min_docs).drop("docs"), "divergence-vocabulary")
    kept = counts.filter("term <> ''").select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"])
    kept = c.written(kept, "divergence-kept")

    langs = counts.filter("term = ''").groupBy("lang").agg(F.count("*").alias("n_groups"))
    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    langs = c.written(langs.join(sizes, "lang", "left").select(
        "lang",
        F.coalesce("v", F.lit(0)).alias("v"),
        F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        F.ceil(F.col("n_groups") / group_block).alias("group_blocks"),
        F.greatest(F.lit(1), F.ceil(F.coalesce("v", F.lit(0)) / term_block)).alias("term_blocks"),
    ), "divergence-langs")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang")
    groups = c.written(groups.withColumn("total", F.coalesce("total", F.lit(0))), "divergence-groups")

    shares = kept.join(groups, ["lang", "source"])
    shares = c.written(shares.withColumn("p", _share("n", "total")).withColumn("q", _share("lang_n", "lang_total")), "divergence-shares")

    over = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    over = over.withColumn("rank", ranked).filter(F.col("rank") <= top_terms)

    term_of = F.expr("pmod(xxhash64(term), term_blocks)")
    group_of = F.expr("pmod(xxhash64(source), group_blocks)")
    in_block = vocabulary.join(langs, "lang").groupBy("lang", term_of.alias("t")).agg(F.count("*").alias("in_block"))
    heads = groups.filter("v > 0").withColumn("t", F.explode(F.expr("sequence(0L, term_blocks - 1)")))
    heads = heads.join(in_block, ["lang", "t"], "left")
    heads = heads.unionByName(groups.filter("v = 0").withColumns({"t": F.lit(0).cast("long"), "in_block": F.lit(0).cast("long")}))
    least = F.when(F.col("v") > 0, _share("0", "total")).otherwise(F.lit(1))
    heads = heads.select("lang", group_of.alias("block"), "t", "group_blocks", "source", F.lit(None).cast("string").alias("term"), least.alias("p"), F.coalesce("in_block", F.lit(0)).alias("in_block"))
    slices = shares.select("lang", group_of.alias("block"), term_of.alias("t"), "group_blocks", "source", "term", "p", F.lit(None).cast("long").alias("in_block"))
    sent = heads.union(slices).withColumn("other", F.explode(F.expr("sequence(0L, group_blocks - 1)")))
    sent = sent.select("lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "t", "block", "source", "term", "p", "in_block")
    parts = sent.groupBy("lang", "a", "b", "t").applyInArrow(_cell, CELLS)
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("part").alias("value"))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked)
    return pairs.unionByName(over)
