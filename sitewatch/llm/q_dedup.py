"""Queries of the near-duplicate operators, and oracle SQL of the Jaccard join."""

from __future__ import annotations

from sitewatch.llm import jaccard_join, simhash_dedup
from sitewatch.llm.common import WS

SHINGLE, MAX_BITS = 4, 4
JOIN_WORDS, JOIN_PERCENT = 3, 90


def op5_simhash_dedup(spark, sf_dir):
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_dedup.near_duplicates(docs, SHINGLE, MAX_BITS)


def op11_ngram_jaccard_join(spark, sf_dir):
    """Set size and component of every document under Jaccard links."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_join.near_duplicates(docs, JOIN_WORDS, JOIN_PERCENT)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Sets, then the shared shingles of all pairs of different sets, then all that is reachable.
JACCARD_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[{WS}]+'),
    lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) <= {JOIN_WORDS}
    THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(
      range(1, len(w) - {JOIN_WORDS - 2}),
      lambda i: array_to_string(w[i:i + {JOIN_WORDS - 1}], ' ')))) END AS s FROM w),
classes AS (SELECT s, len(s) AS n, min(doc_id) AS least, row_number() OVER () AS cid
  FROM s WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT cid, n, unnest(s) AS token FROM classes),
links AS (SELECT a.cid AS a, b.cid AS b FROM tokens a JOIN tokens b ON a.token = b.token
  AND a.cid <> b.cid AND 100 * least(a.n, b.n) >= {JOIN_PERCENT} * greatest(a.n, b.n)
  GROUP BY a.cid, b.cid
  HAVING 100 * count(*) >= {JOIN_PERCENT} * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT cid AS a, cid AS b FROM classes
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
best AS (SELECT x.s, min(y.least) AS least FROM reach JOIN classes x ON reach.a = x.cid
  JOIN classes y ON reach.b = y.cid GROUP BY x.s)
SELECT doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
  CASE WHEN len(s.s) = 0 THEN doc_id ELSE best.least END AS component_id
FROM s LEFT JOIN best ON s.s = best.s"""

QUERIES = {"op5_simhash_dedup": op5_simhash_dedup,
           "op11_ngram_jaccard_join": op11_ngram_jaccard_join}
ORACLE = {"op11_ngram_jaccard_join": JACCARD_SQL}
