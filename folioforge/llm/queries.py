"""The training-data queries and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import bpe, conversations, decontaminate, html, jaccard, lines, passages, quality, resampling, secrets, sharding, simhash, urlfilter


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_secrets": secrets.digest,
    "op2_decontamination": decontaminate.digest,
    "op3_quality": quality.digest,
    "op4_urls": urlfilter.digest,
    "op5_html": html.digest,
    "op6_sharding": sharding.digest,
    "op7_bpe": bpe.digest,
    "op8_simhash": simhash.digest,
    "op9_passages": passages.digest,
    "op10_lines": lines.digest,
    "op11_resampling": resampling.digest,
    "op12_jaccard": jaccard.digest,
    "op13_conversations": conversations.digest,
    "pipeline": pipeline,
}

ORACLES = {
    "op1_secrets": secrets.SQL,
    "op3_quality": quality.SQL,
    "op4_urls": urlfilter.SQL,
    "op10_lines": lines.SQL,
}
