"""Queries of the token operators: counts and packing."""

from __future__ import annotations

import public_tokenizers
from sitewatch.llm import packing, token_counts

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
CAPACITY = 2048


def op8_token_counts(spark, sf_dir, vocabulary: str | None = None):
    """Tokens of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts.token_counts(docs, vocabulary or public_tokenizers.path(VOCABULARY), LIMIT)


def op10_best_fit_packing(spark, sf_dir, vocabulary: str | None = None):
    """Every document, cut and placed in sequences of at most CAPACITY tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cut = packing.pieces(docs, vocabulary or public_tokenizers.path(VOCABULARY), CAPACITY)
    return packing.pack(cut, CAPACITY)


QUERIES = {"op8_token_counts": op8_token_counts, "op10_best_fit_packing": op10_best_fit_packing}
ORACLE: dict[str, str] = {}
