"""The driver's tables read as the entities of a corpus service, and the same views for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as citable chunks: every seventeenth has no page, every thirteenth no external id."""
    d = read(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("source_id"),
        F.when(F.col("doc_id") % 13 != 0, F.concat(F.lit("x"), F.col("doc_id"))).alias("external_id"),
        F.concat_ws(" ", "source", F.col("doc_id").cast("string")).alias("citation"),
        F.col("lang").alias("jurisdiction"),
        "text",
        F.when(F.col("doc_id") % 17 != 0, F.col("n_chars") % 50).alias("page_start"),
        F.floor(F.col("doc_id") / 10).alias("created_at"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source for each distinct `source`; its number decides between the two layers."""
    number = F.regexp_extract("id", r"(\d+)", 1).cast("int")
    kinds = read(spark, sf_dir, "documents").groupBy(F.col("source").alias("id")).agg(F.min("lang").alias("jurisdiction"), F.min("doc_id").alias("created_at"))
    return kinds.withColumns({"title": F.concat(F.lit("Title "), F.col("id")), "source_type": F.when(number % 2 == 0, "commentary").otherwise("textbook")})


def footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("chunk_id"), F.col("turn").alias("number"), "text")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


#: The same views as common table expressions.
CHUNKS = """chunks AS (
  SELECT doc_id AS id, source AS source_id, CASE WHEN doc_id % 13 <> 0 THEN 'x' || doc_id END AS external_id,
         source || ' ' || doc_id AS citation, lang AS jurisdiction, text,
         CASE WHEN doc_id % 17 <> 0 THEN n_chars % 50 END AS page_start, doc_id // 10 AS created_at FROM documents)"""
SOURCES = r"""sources AS (
  SELECT id, jurisdiction, created_at, 'Title ' || id AS title,
         CASE WHEN regexp_extract(id, '(\d+)', 1)::INT % 2 = 0 THEN 'commentary' ELSE 'textbook' END AS source_type
  FROM (SELECT source AS id, min(lang) AS jurisdiction, min(doc_id) AS created_at FROM documents GROUP BY source))"""
FOOTNOTES = "footnotes AS (SELECT conv_id AS chunk_id, turn AS number, text FROM conversations)"
