"""A corpus pipeline of five stages over ``documents``.

Each stage takes what its predecessor kept and returns the columns of
``documents``; the last returns the packed pieces. Between stages the rows
are written as Parquet and read again, so a lost executor costs one stage.

Near duplicates are told by five-word shingles at a similarity of 0.8. Of a
group of near duplicates the row with the smallest id stays. Documents that
overlap a benchmark item go. Personal data are replaced by their kind, and
``n_chars`` follows the text. Texts go to Python workers in batches of a few
megabytes, as the workers of all stages share one executor's memory.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossgrain.llm import decontaminate, perplexity_rules, pii_crf, sequence_packing, trie_join
from lossgrain.llm.common import small_batches, table_if_there
from lossgrain.session import pin


def in_small_batches(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return perplexity_rules.keep(docs, labels=table_if_there(spark, sf_dir, "labels"))


@in_small_batches
def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return trie_join.first_of_groups(docs, words=5, percent=80)


@in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_small_batches
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii_crf.redact(docs, pii_crf.fit(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return clean


@in_small_batches
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sequence_packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: The stages are models, searches and packings, which SQL cannot express; tests hold them
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
