"""From raw documents to token ids: quality, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. The filtering
stages drop rejected documents, the line stage changes texts, the last returns the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platterwatch.llm import bpe, catalog, decontaminate, lines, quality, simhash
from platterwatch.sources.storage import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = catalog.quality_model(docs, catalog.table(spark, sf_dir, "labels"))
    return quality.good_documents(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand on many sites; n_chars, one of the columns of documents, follows the
    text. A null text keeps a null n_chars."""
    cleaned = lines.without_boilerplate(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.clean(spark, docs, catalog.table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of token ids, digests of the ids and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN, "doc_id")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level bpe", tokens),
]

ORACLE_SQL = None  # classifier, fingerprints and tokenizer cannot be written as SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; every stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
