"""A corpus pipeline over five operators of tidemark.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored
as Parquet in the shared folder and read back as the next stage's docs. All but the
last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, quality_model, simhash, token_files
from tidemark.sources.durable import checkpoint

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, accepts."""
    model = quality_model.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.good_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles)."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: each row is what one pass takes of a document."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows, and where each document is in them: doc_id, start, n_tokens, ids_crc32."""
    stored = token_files.write_token_files(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_token_files(stored)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("tokens", tokens),
]

# The model, the fingerprints and the mix are not to be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return docs
