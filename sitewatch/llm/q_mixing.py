"""Query and oracle SQL of source mixing."""

from __future__ import annotations

from sitewatch.llm import mixing as M
from sitewatch.llm.common import WS

COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


def op9_source_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return M.mix(docs).select(*COLUMNS)


# The threshold found by nested histograms is where the running sum in hash order
# ends, so SQL may sort: rows of one hash are peers, and are taken if half fits.
SQL = f"""WITH sizes AS (SELECT doc_id, source,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[{WS}]+'), lambda x: x <> ''))
         AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {M.HASH_BITS // 4}) AS BIGINT)
      AS hash FROM documents),
weighed AS (SELECT source, CAST(sum(size) AS BIGINT) AS s,
    CAST({list(M.WEIGHTS)}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1)
      % {len(M.WEIGHTS)}] AS BIGINT) AS w FROM sizes GROUP BY source),
levels AS (SELECT *, row_number() OVER o AS r,
    CAST(sum(s) OVER () - coalesce(sum({M.MOST} * s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighed WINDOW o AS (ORDER BY CAST({M.MOST} * s AS DOUBLE) / w, source NULLS LAST)),
final AS (SELECT min(r) AS r0, min_by(level, r) AS level FROM levels WHERE {M.MOST} * s > w * level),
plan AS (SELECT source, s AS source_size,
    CASE WHEN r >= r0 THEN w * final.level ELSE CAST({M.MOST} * s AS DOUBLE) END AS target
  FROM levels LEFT JOIN final ON true),
passes AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT),
    {M.MOST}) ELSE 0 END AS whole FROM plan),
ranked AS (SELECT d.*, source_size, target, whole,
    greatest(0, target - whole * source_size) AS part,
    sum(size) OVER (PARTITION BY d.source ORDER BY hash RANGE UNBOUNDED PRECEDING) AS upto,
    sum(size) OVER (PARTITION BY d.source, hash) AS held
  FROM sizes d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN part > 0 AND part - (upto - held) >= held / 2 THEN 1 ELSE 0 END)
    AS BIGINT) AS taken FROM ranked"""

QUERIES = {"op9_source_mixing": op9_source_mixing}
ORACLE = {"op9_source_mixing": SQL}
