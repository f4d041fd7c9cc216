"""Query and oracle SQL of exact top-k search."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewatch.llm import topk_search

K, SCALE, EVERY = 5, 256, 50


def op6_exact_top_k(spark, sf_dir):
    """The 5 best of all vectors for every vec_id divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk_search.top_k(vectors, K, F.col("vec_id") % EVERY == 0, SCALE)


SQL = f"""WITH v AS (SELECT vec_id, list_transform(embedding,
    lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec)
  WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id
    ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs)
SELECT * FROM ranked WHERE rank <= {K}"""

QUERIES = {"op6_exact_top_k": op6_exact_top_k}
ORACLE = {"op6_exact_top_k": SQL}
