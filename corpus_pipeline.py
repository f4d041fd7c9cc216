"""The corpus pipeline: five stages over ``documents``, each one operator of sitewatch.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``; extra columns pass through.

1. quality_rules: documents that the rules reject go.
2. near_duplicates: of each SimHash group one document stays (the smallest doc_id).
3. secret_scans: secrets are replaced in the text, n_chars follows; no document goes.
4. source_mixing: a document is repeated as often as the mix takes it.
5. packing: the pieces of all documents, with their token ids, and their places in
   sequences.

Defined cases are those of the operators: NULL and empty texts fail the quality
rules; repeated rows are one near-duplicate group; very long texts are judged, redacted and packed whole, in as many pieces as they need;
columns of ``documents`` are read by name, extra ones, of any name, pass through and are
left out of the pieces; an empty table gives no rows. A document that the mix takes twice
is packed twice, in pieces with the same doc_id and another ``doc_row``.

Every stage's work tables, and the table it read, are deleted once its own is written.

The near-duplicate stage keeps components of fingerprint links and the secret scan
is a fitted model, so SQL cannot express run(): ORACLE_SQL is None, and the tests
hold the stages against brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sitewatch.llm import mixing, packing, quality_rules, secret_scan, simhash_dedup
from sitewatch.llm.common import discard, work_tables, written
from sitewatch.llm.q_dedup import MAX_BITS, SHINGLE
from sitewatch.llm.q_tokens import CAPACITY, VOCABULARY


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.deduplicated(docs, SHINGLE, MAX_BITS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = packing.pieces(docs, public_tokenizers.path(VOCABULARY), CAPACITY, with_ids=True)
    return packing.pack(cut, CAPACITY)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", dedup_stage),
    ("secret_scans", secrets_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with work_tables(spark) as keep:
            docs = keep(written(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        if before is not None:
            discard(before)
        before = docs
    packed = STAGES[-1][1](spark, docs, sf_dir)
    discard(before)  # the pieces are written
    return packed
