"""The registered queries of this subpackage, over whole tables, and SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platterwatch.llm import (
    bpe,
    decontaminate,
    language,
    licenses,
    lines,
    near_vectors,
    quality,
    ranked_search,
    rules,
    secrets,
    simhash,
    token_shards,
    vector_codes,
    vector_sql,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(parts: int) -> Column:
    """crc32 of doc_id as text, modulo the number of parts; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(
        spark, table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judged(table(spark, folder, "documents"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.components_of(table(spark, folder, "documents"))


def op4_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_shards.round_trip(table(spark, folder, "documents"), path)


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels, weights = language.fit(docs, F.coalesce(fold(3) != 1, F.lit(False)))
    held_out = F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out")
    return language.predict(docs.select("doc_id", held_out, "text"), labels, weights, "doc_id", "held_out")


def quality_model(docs: DataFrame, labels: DataFrame):
    return quality.fit(docs, labels, F.coalesce(fold(5) != 0, F.lit(False)))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_model(docs, table(spark, folder, "labels"))
    held_out = F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out")
    scored = quality.scored(docs.select("doc_id", held_out, "text"), model, "doc_id", "held_out")
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, folder, "documents")
    return bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN, "doc_id")


def op8_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.without_boilerplate(table(spark, folder, "documents"), removed="n_removed")
    return found.select("doc_id", "text", "n_removed")


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(table(spark, folder, "documents"))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents"))


def op11_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, folder, "embeddings"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, folder, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_quality_rules, op3_simhash, op4_token_shards, op5_language,
        op6_quality, op7_byte_bpe, op8_line_spread, op9_secrets, op10_licenses,
        op11_near_vectors, op12_ranked_search, op13_vector_codes,
    )
}

LINE_SPREAD = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, * FROM documents
), lines AS (
  SELECT r, doc_id, source, unnest(range(1, len(p) + 1)) AS place, unnest(p) AS line
  FROM (SELECT r, doc_id, source, string_split(text, chr(10)) AS p FROM docs WHERE text IS NOT NULL)
), boiler AS (
  SELECT trim(line, ' ') AS t, min(doc_id) AS first_doc
  FROM lines WHERE length(trim(line, ' ')) >= {lines.SHORTEST}
  GROUP BY t HAVING count(DISTINCT source) >= {lines.SITES}
), found AS (
  SELECT l.r, l.place,
         l.doc_id = b.first_doc AND l.place = min(l.place) OVER (PARTITION BY l.r, b.t) AS stays
  FROM lines l JOIN boiler b ON trim(l.line, ' ') = b.t
), rebuilt AS (
  SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.place)
           FILTER (WHERE f.r IS NULL OR f.stays) AS text,
         count(*) FILTER (WHERE f.r IS NOT NULL AND NOT f.stays) AS n_removed
  FROM lines l LEFT JOIN found f ON l.r = f.r AND l.place = f.place GROUP BY l.r
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(b.text, '') END AS text,
       CAST(coalesce(b.n_removed, 0) AS BIGINT) AS n_removed
FROM docs d LEFT JOIN rebuilt b ON b.r = d.r
"""

ORACLE: dict[str, str] = {"op8_line_spread": LINE_SPREAD, **vector_sql.ORACLE}
