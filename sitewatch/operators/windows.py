"""Event-time window aggregates: averages, tier rollups, windowed counts.

All windows are Spark's ``window()`` (aligned to the epoch, like the
reference's TUMBLE/sliding windows). Grouping is always by (key, window), so a
hot site is spread over its many windows and partial aggregation runs
map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatch import schemas as S
from sitewatch.functions.numeric import average, binned_parts, finished, merged_parts


def _labelled(df: DataFrame, key: str, sensors, code: Column,
              label_offset_hours: int) -> DataFrame:
    """``key, end_time, type, avg_<sensor>...`` from rows with a window ``w``."""
    end = F.col("w.end")
    if label_offset_hours:
        end = end + F.make_dt_interval(F.lit(0), F.lit(label_offset_hours))
    return df.select(F.col(key), end.alias("end_time"), code.alias("type"),
                     *[F.col(s).alias(f"avg_{s}") for s in sensors])


def window_averages(reports: DataFrame, tier=1, ts: str = "ts",
                    key: str = "site_id", sensors=S.SENSORS,
                    label_offset_hours: int = 0) -> DataFrame:
    """AGG-1: tumbling average of each sensor per site, labelled by window end.

    Output: ``site_id, end_time, type, avg_<sensor>...`` (``type`` = tier code).
    ``label_offset_hours`` shifts only the label (the reference writes +8 h).
    Works on streaming frames after ``withWatermark(ts, ...)``.
    """
    t = S.tier(tier)
    out = average(reports, [F.col(key), F.window(F.col(ts), t.duration).alias("w")], sensors)
    return _labelled(out, key, sensors, F.lit(t.code), label_offset_hours)


def rollup(averages: DataFrame, from_tier, key: str = "site_id",
           sensors=S.SENSORS, site_id=None, start=None, end=None,
           end_stamped: bool = False, label_offset_hours: int = 0) -> DataFrame:
    """AGG-2/AGG-3: re-average tier ``from_tier`` rows into the next tier.

    Unweighted mean of the stored averages per (site, coarser window), the
    window being taken on ``end_time`` (so an hour ending 00:00 belongs to the
    next day, as in the reference); ``end_stamped=True`` moves each row 1 us
    back, into the window it covers. Optional SRC-3 filters: one site and an
    inclusive ``end_time`` range.
    ``label_offset_hours`` shifts only the written label (reference: +8 h).
    """
    src, dst = S.tier(from_tier), S.next_tier(from_tier)
    df = averages.where(F.col("type") == src.code)
    if site_id is not None:
        df = df.where(F.col(key) == site_id)
    if start is not None:
        df = df.where(F.col("end_time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col("end_time") <= F.lit(end).cast("timestamp"))
    event_time = F.col("end_time")
    if end_stamped:
        event_time = event_time - F.expr("INTERVAL 1 MICROSECOND")
    df = df.select(key, event_time.alias("_t"), *[F.col(f"avg_{s}").alias(s) for s in sensors])
    out = average(df, [F.col(key), F.window("_t", dst.duration).alias("w")], sensors)
    return _labelled(out, key, sensors, F.lit(dst.code), label_offset_hours)


def window_counts(df: DataFrame, key: str, duration: str, slide: str | None = None,
                  ts: str = "ts", count_col: str | None = None,
                  name: str = "cnt") -> DataFrame:
    """AGG-4/5/6/7: count per key per tumbling or sliding window.

    ``count_col`` counts non-NULL values of that column (``COUNT(url)``);
    default counts rows. Output: ``key, window_start, window_end, <name>``.
    """
    w = F.window(F.col(ts), duration, slide) if slide else F.window(F.col(ts), duration)
    counted = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    return (df.groupBy(F.col(key), w.alias("w"))
              .agg(counted.alias(name))
              .select(F.col(key), F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), F.col(name)))


def tier_table(reports: DataFrame, tiers=(1, 2, 3, 4, 5), ts: str = "ts",
               key: str = "site_id", sensors=S.SENSORS) -> DataFrame:
    """All requested tiers of AGG-1 in one averaged table, from one pass.

    Sums and counts are taken once at the finest requested tier; each of those
    (few) rows is then added to its window of every tier. Coarser windows are
    unions of finer ones (all are aligned to the epoch), so the averages equal
    those taken from the reports.
    """
    chosen = sorted((S.tier(t) for t in tiers), key=lambda t: t.minutes)
    finest = chosen[0]
    if any(t.minutes % finest.minutes for t in chosen):
        raise ValueError("every tier must be a multiple of the finest one")
    parts = binned_parts(reports, [F.col(key), F.window(F.col(ts), finest.duration).alias("w")],
                         sensors)
    each = F.explode(F.array(*[
        F.struct(F.lit(t.code).alias("type"), F.lit(t.minutes * 60).alias("secs"))
        for t in chosen])).alias("_tier")
    spread = parts.select("*", each).withColumn("type", F.col("_tier.type")).withColumn(
        "end_time", F.expr("timestamp_seconds((floor(unix_seconds(w.start) / _tier.secs) + 1)"
                           " * _tier.secs)"))
    keys = [key, "end_time", "type"]
    out = finished(merged_parts(spread, keys, sensors), keys, sensors)
    return out.select(*keys, *[F.col(s).alias(f"avg_{s}") for s in sensors])


def as_ntz(c) -> Column:
    """Instant -> TIMESTAMP_NTZ (session zone UTC) for zone-free outputs."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")
