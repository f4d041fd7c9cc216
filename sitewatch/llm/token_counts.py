"""Token counts: every whole text's number of tokens, computed in Arrow batches.

Only lengths leave the Python worker. Defined cases: NULL is the empty text (0
bytes, 0 tokens); special-token strings inside a text count as the library counts
them; repeated rows are all returned; other columns are left out unless named in
``keep``.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import ship
from sitewatch.llm.token_ids import encoder


def count_udf(vocabulary: str):
    """Arrow function text -> number of tokens for the tokenizer file at ``vocabulary``."""
    @F.arrow_udf("long")
    def n_tokens(text: pa.Array) -> pa.Array:
        counts = encoder(vocabulary, False).encode(pc.fill_null(text, ""))
        return pa.array(counts, pa.int64())
    return n_tokens


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024,
                 keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_bytes, n_tokens and over_limit (more than ``limit`` tokens)."""
    ship(docs.sparkSession)
    counted = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    counted = counted.select(*keep, F.octet_length("_text").cast("long").alias("n_bytes"),
                             count_udf(vocabulary)("_text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
