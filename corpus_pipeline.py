"""A training corpus from raw documents: each stage applies one operator of ``webtab.llm`` to what the stage before kept.

Stages take (spark, docs, sf_dir) and return a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``. Each stage holds for null ids and texts, repeated rows, empty
tables and more columns as its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webtab.llm import decontaminate, exact_dedup, language, packing, simhash
from webtab.session import scratch_path

CAPACITY = 2048
END_ID = 0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages from the labelled rows of ``docs``; documents that are mostly in none of them go."""
    return language.keep_known(docs, language.learn(docs))


def first_of_equal_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space the one with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest doc_id stays."""
    return simhash.keep_one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences of ``CAPACITY`` tokens."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, CAPACITY)


STAGES = [
    ("language", known_language),
    ("exact_dedup", first_of_equal_texts),
    ("simhash_near_dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

# models and tokenizers are beyond SQL; tests compare each stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)
