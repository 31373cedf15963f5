"""A training-data pipeline over ``documents`` made of five operators of gridops.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs. All but the last return the columns they got.
Extra columns, nulls, repeated rows and empty tables pass as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridops.llm import common, decontaminate, jaccard_join, language_id, mixing, sharding

#: A text of which less than this share is in one language is rejected: mixtures of three or
#: more languages. Texts in two languages, or with a foreign licence line, stay.
LEAST_SCORE = 0.4


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without letters, and those that no language holds enough of, go."""
    return language_id.keep_identified(docs, language_id.train(docs), LEAST_SCORE)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (five words, 0.8): one document of each group stays."""
    return jaccard_join.drop_near_copies(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or nearly so, go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), share=0.2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights; a document taken twice is two rows."""
    return mixing.mixed(docs).select("row.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-equal shards; the rows with ``shard`` and ``slot`` (in place of such columns)."""
    kept = [x for x in docs.columns if x.lower() not in ("shard", "slot")]
    return sharding.shard(docs, n_shards=40, keep=kept).select("row.*", "shard", "slot")


STAGES = [
    ("language_id", language_stage),
    ("jaccard_join", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The learned, hashed and sampled stages have no SQL form; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
