"""The corpus pipeline: every stage on its own input, against brute force."""

import collections
import os

import pytest
from pyspark.sql import functions as F
from test_text_operators import brute_components, brute_edit, words

import corpus_pipeline
from gridops.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("text IS NOT NULL").orderBy("item_id").first()
    odd = spark.createDataFrame(
        [(90_001, None, None, None, None), (90_002, "", "en", "src0", 0), (90_003, "12 34", "en", "src0", 5), (90_004, "some words " + item.text + " and more", "en", "src1", 9)],
        docs.schema,
    )
    again = docs.orderBy("doc_id").limit(3)
    docs.union(odd).union(again).withColumn("size", F.lit("extra")).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
    return d


def bag(df):
    return collections.Counter(map(str, (tuple(r) for r in df.collect())))


def test_stages_in_turn(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(path := str(tmp_path / name))
        steps[name] = (docs, docs := spark.read.parquet(path))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "mixing", "sharding"]

    before, after = steps["language_id"]
    gone = bag(before) - bag(after)
    letters = {r.doc_id for r in before.collect() if any(ch.isalpha() for ch in r.text or "")}
    assert {r.doc_id for r in after.collect()} == letters and sum(gone.values()) == 3

    before, after = steps["jaccard_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    keep = {c if n else i for i, n, c in brute_components(rows, 5, 80)}
    assert collections.Counter(r.doc_id for r in after.collect()) == collections.Counter(keep)

    before, after = steps["decontamination"]
    items = [words((r.text or "").lower()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in after.collect()}
    assert 90_004 not in kept
    for r in before.collect():
        w = words((r.text or "").lower())
        whole = any(x and x == w[k : k + len(x)] for x in items for k in range(len(w) - len(x) + 1))
        if whole:
            assert r.doc_id not in kept
        elif r.doc_id not in kept:  # then some window is near an item
            assert any(x and brute_edit(x, w[k : k + len(x)]) <= len(x) // 5 for x in items for k in range(len(w) - len(x) + 1))

    before, after = steps["mixing"]
    assert set(bag(after)) <= set(bag(before)) and max(bag(after).values()) <= 3

    before, after = steps["sharding"]
    assert bag(after.select(*before.columns)) == bag(before)
    slots = collections.defaultdict(list)
    for r in after.select("shard", "slot").collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_run_is_the_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "text", "lang", "source", "n_chars", "size", "shard", "slot"} == set(out.columns)
    assert out.count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark, folder, tmp_path):
    d = str(tmp_path)
    spark.read.parquet(f"{folder}/documents.parquet").filter("false").write.parquet(f"{d}/documents.parquet")
    os.symlink(f"{folder}/benchmark.parquet", f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
