"""TOP-1 / TOP-2: the N busiest sites of every (sliding) window.

Batch: a ranking window partitioned by the time window (not by site), which
Spark plans as a partial + final ``WindowGroupLimit`` so only N rows per
window and partition cross the shuffle. Ties are broken by site ascending.

Streaming: window functions over non-time partitions are not allowed, so the
per-window cut is done by chained aggregations over the window in append mode,
level by level over site buckets, so no list holds all sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.operators.windows import window_counts


def top_n_per_window(counts: DataFrame, n: int = 3, key: str = "site_id",
                     value: str = "cnt",
                     window_cols=("window_start", "window_end")) -> DataFrame:
    """Keep the ``n`` highest ``value`` rows per window; adds ``rank`` (1..n)."""
    w = Window.partitionBy(*window_cols).orderBy(F.col(value).desc(), F.col(key).asc())
    return (counts.withColumn("rank", F.row_number().over(w))
                  .where(F.col("rank") <= n))


def top_sites_sliding(reports: DataFrame, n: int = 3, size: str = "10 seconds",
                      slide: str = "5 seconds", ts: str = "ts",
                      key: str = "site_id") -> DataFrame:
    """Counts per site in sliding windows, then the top ``n`` per window."""
    return top_n_per_window(window_counts(reports, key, size, slide, ts=ts), n, key)


def top_n_streaming(reports: DataFrame, n: int = 3, size: str = "10 seconds",
                    slide: str = "5 seconds", ts: str = "ts",
                    key: str = "site_id", levels=(4096, 64)) -> DataFrame:
    """Streaming form (append mode; ``reports`` must carry a watermark).

    Counts per (window, site), then the top ``n`` per (window, site bucket) with
    each number of buckets of ``levels`` in turn, then per window. A level's
    buckets must divide the level before it, so that a bucket is a union of
    earlier ones: its list holds at most (ratio of the levels) * ``n`` entries
    whatever the number of sites. Only the first level's lists grow, as
    sites / levels[0]; give it about as many buckets as a thousandth of the
    sites. The cut is exact: a window's top ``n`` are each within the top ``n``
    of every bucket they fall in. Ties go to the lower site id.
    """
    if any(a % b for a, b in zip(levels, levels[1:])):
        raise ValueError("each level must divide the one before it")
    def ranked(entries):
        return F.expr(f"slice(array_sort({entries}), 1, {n})").alias("top")

    top = (reports.groupBy(F.window(F.col(ts), size, slide).alias("window"), F.col(key))
                  .agg(F.count(F.lit(1)).alias("cnt")))
    entries = f"collect_list(named_struct('neg', -cnt, 'k', `{key}`))"
    bucket = f"pmod(hash(`{key}`), {{}})"
    for buckets in levels:
        top = top.groupBy("window", F.expr(bucket.format(buckets)).alias("_bucket")).agg(
            ranked(entries))
        entries, bucket = "flatten(collect_list(top))", "pmod(_bucket, {})"
    per_window = top.groupBy("window").agg(ranked(entries))
    return (per_window.select("window", F.posexplode("top").alias("pos", "t"))
                      .select(F.col("window.start").alias("window_start"),
                              F.col("window.end").alias("window_end"),
                              F.col("t.k").alias(key), (-F.col("t.neg")).alias("cnt"),
                              (F.col("pos") + 1).alias("rank")))
