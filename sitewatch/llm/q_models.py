"""Queries of the fitted classifiers: toxicity and quality."""

from __future__ import annotations

from sitewatch.llm import quality_model, toxicity


def op3_toxicity(spark, sf_dir):
    """Expected severity of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxicity.severities(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_quality_classifier(spark, sf_dir):
    """Quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_model.quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op3_toxicity": op3_toxicity, "op7_quality_classifier": op7_quality_classifier}
ORACLE: dict[str, str] = {}
