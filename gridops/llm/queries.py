"""One query per numbered operator, applied with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.llm import decontaminate, html_extract, jaccard_join, language_id, mixing, pii, prefix_trie, sharding, source_divergence, substring_dedup, token_counts, topk_search, url_filter


#: The public vocabulary that op8 counts with; read on the driver.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32("text").alias("text_crc32"))
    return sharding.shard(docs, n_shards=40, overhead=16, keep=["doc_id", "text_crc32"]).select(
        "row.doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("row.doc_id", *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), share=0.2)
    return found.select("doc_id", "item_id", "start", "item_words", "passage_words", "distance")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"), min_words=50)
    return summary.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(_table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), token_counts.pieces_of(VOCABULARY))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_repeats=3, shards=40, keep=["doc_id"])
    shards = F.array_join(F.array_sort(F.col("draws.shard")), ",")
    return plan.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), shards.alias("shards"))


def op10_impact_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"), group=5, longest=9)


#: The URL list: (host, path, verdict).
URL_LIST = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.url_list(spark, URL_LIST), keep=["page_id"])
    return found.select("row.page_id", "host", "path", "rule", "verdict", "how")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergences(_table(spark, sf_dir, "documents"), min_docs=3, top_terms=200)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sampled_splitters,
        op2_pii,
        op3_decontamination,
        op4_substring_dedup,
        op5_jaccard_join,
        op6_html_extraction,
        op7_language_id,
        op8_token_counts,
        op9_mixing,
        op10_impact_index,
        op11_prefix_trie,
        op12_url_rules,
        op13_source_divergence,
    )
}
