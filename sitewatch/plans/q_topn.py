"""Queries over windowed counts and top-N (AGG-4..AGG-7, TOP-1/2, ST-6/7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewatch import fixtures as FX
from sitewatch.operators.topn import top_sites_sliding
from sitewatch.operators.windows import as_ntz, window_counts
from sitewatch.plans import oracle as O
from sitewatch.plans.catalog import register

SLIDING_SQL = f"""WITH {O.REPORTS},
sw AS (
  SELECT site_id,
         time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01')
           - to_seconds(5 * k) AS window_start
  FROM reports CROSS JOIN (VALUES (0), (1)) v(k)),
counts AS (
  SELECT site_id, window_start, window_start + INTERVAL '10 seconds' AS window_end,
         COUNT(*) AS cnt
  FROM sw GROUP BY ALL)"""


@register("site_count_sliding", SLIDING_SQL + "\nSELECT * FROM counts")
def q_site_count_sliding(spark, sf_dir):
    """AGG-4/5/6 + ST-7: reports per site in 10 s windows sliding by 5 s."""
    c = window_counts(FX.reports(spark, sf_dir), "site_id", "10 seconds", "5 seconds")
    return c.select("site_id", as_ntz("window_start").alias("window_start"),
                    as_ntz("window_end").alias("window_end"), "cnt")


@register("top3_sites_sliding", SLIDING_SQL + """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, window_end
                               ORDER BY cnt DESC, site_id) AS rank
  FROM counts) WHERE rank <= 3""")
def q_top3(spark, sf_dir):
    """TOP-1/TOP-2: the 3 busiest sites of every sliding window."""
    t = top_sites_sliding(FX.reports(spark, sf_dir), n=3)
    return t.select("site_id", as_ntz("window_start").alias("window_start"),
                    as_ntz("window_end").alias("window_end"), "cnt",
                    F.col("rank").cast("long").alias("rank"))


@register("hourly_count_by_user", f"""WITH {O.CLICKS}
SELECT "user", time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01')
         + INTERVAL '1 hour' AS window_end,
       COUNT(url) AS cnt
FROM clicks GROUP BY ALL""")
def q_hourly_count(spark, sf_dir):
    """AGG-7 + ST-6: COUNT(url) per user per 1-hour tumbling window."""
    c = window_counts(FX.clicks(spark, sf_dir), "user", "1 hour", count_col="url")
    return c.select("user", as_ntz("window_end").alias("window_end"), "cnt")
