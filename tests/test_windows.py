"""Golden tests for windowed aggregates, exact averages and tiers."""

import datetime as dt
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sitewatch import schemas as S
from sitewatch.functions.numeric import average
from sitewatch.operators.windows import rollup, tier_table, window_averages, window_counts

UTC = dt.timezone.utc


def _ts(ms):
    return dt.datetime.fromtimestamp(ms / 1000, tz=UTC).replace(tzinfo=None)


def test_hourly_count(spark):
    """Users alone, together, across an hour's edge and with a NULL url."""
    minute = 60_000
    events = [("u1", "/a", 0), ("u1", "/b", 59 * minute + 59_999), ("u1", "/a", 60 * minute),
              ("u2", "/c", 5 * minute), ("u2", None, 6 * minute), ("u3", "/a", 150 * minute)]
    df = spark.createDataFrame(events, "user string, url string, timestamp long") \
        .withColumn("ts", F.timestamp_millis("timestamp"))
    got = {(r.user, r.window_end.hour): r.cnt
           for r in window_counts(df, "user", "1 hour", count_col="url").collect()}
    expect = Counter((u, t // (60 * minute) + 1) for u, url, t in events if url is not None)
    assert got == expect


def _averages(df):
    return average(df, ["g"], ["x"]).select("g", F.col("x").alias("a"))


def test_average_nulls_nan_infinities_and_empty(spark):
    inf = float("inf")
    rows = [(1, 1.25), (1, None), (1, 2.5), (2, None), (3, float("nan")), (3, 1.0),
            (4, 1e20), (4, 1.0), (5, 0.123456), (5, 0.5), (6, inf), (6, 3.0),
            (7, inf), (7, -inf), (8, -inf), (9, inf), (9, float("nan"))]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r.a for r in _averages(df).collect()}
    assert got[1] == (1.25 + 2.5) / 2
    assert got[2] is None
    assert math.isnan(got[3]) and math.isnan(got[7]) and math.isnan(got[9])
    assert got[4] == 5e19
    assert got[5] == (0.123456 + 0.5) / 2
    assert got[6] == inf and got[8] == -inf


@pytest.mark.parametrize("decimals", [2, 7, 15])
def test_average_is_partition_independent(spark, decimals):
    """Also for readings with more decimals than the unit has, NaN among them."""
    vals = [round((i * 7919) % 10007 / 97.0, decimals) for i in range(3000)]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vals)], "g int, x double")
    one = {r.g: r.a for r in _averages(df.repartition(1)).collect()}
    many = {r.g: r.a for r in _averages(df.repartition(7, "x")).collect()}
    assert one == many
    for g in range(3):
        assert one[g] == math.fsum(vals[g::3]) / len(vals[g::3])


def _check_groups(spark, groups, parts=5):
    rows = [(g, x) for g, xs in enumerate(groups) for x in xs]
    df = spark.createDataFrame(rows, "g int, x double").repartition(parts)
    got = {r.g: r.a for r in _averages(df).collect()}
    for g, xs in enumerate(groups):
        assert got[g] == math.fsum(xs) / len(xs), (g, xs)


def test_average_of_any_magnitude(spark):
    """Small beside large, cancelling, subnormal, negative and bin-edge readings."""
    edges = [s * 2.0**e * m for s in (1, -1) for e in (-11, -10, 10, 11, 31, 32)
             for m in (1.0, 1 - 2**-53, 1 + 2**-52)]
    _check_groups(spark, [
        [2e-11], [2e-11, 0.0], [1e30], [1e30, 1.0, -1e30], [1e300, 1e-300, -1e300],
        [1e300, 1e-300], [-1e300, 1e-300], [5e-324, 5e-324, 1e-310], [0.1] * 10, [0.0, -0.0],
        [1.0, 2.0**-53, 2.0**-106], [1.0, 2.0**-53, -2.0**-106], [-1.0, -2.0**-53, -2.0**-1000],
        [1.0, 2.0**-52, 2.0**-53], [3.0, -3.0, 1e-200], [1e16, 1.0, -1e16, 1e-16], edges])


def test_average_beyond_the_largest_sum(spark):
    big = 1.7e308
    df = spark.createDataFrame([(1, big), (1, big), (2, big), (2, -big), (2, 1.0)],
                               "g int, x double")
    assert {r.g: r.a for r in _averages(df).collect()} == {1: big, 2: 1 / 3}


def test_merged_parts_equal_the_whole(spark):
    df = spark.range(1000).selectExpr("CAST(id % 4 AS INT) AS site_id", "id / 7D AS tmp",
                                      "CAST(NULL AS DOUBLE) AS hmt", "id * 1D AS lx",
                                      "timestamp_seconds(id * 9000) AS ts")
    stacked = tier_table(df, (3, 4, 5))
    for code in (3, 4, 5):
        cols = ["site_id", "end_time", "type", "avg_tmp", "avg_hmt", "avg_lx"]
        direct = {tuple(r) for r in window_averages(df, tier=code).select(*cols).collect()}
        assert {tuple(r) for r in stacked.where(F.col("type") == code).select(*cols)
                .collect()} == direct


def test_tier_lookup():
    assert S.tier(1).minutes == 1 and S.tier("week").minutes == 10080
    assert S.next_tier(2).name == "DAY"
    assert S.tier(5).minutes == 43200
    with pytest.raises(ValueError):
        S.tier(6)
    with pytest.raises(ValueError):
        S.next_tier(5)


def _avg_rows(spark, rows):
    return spark.createDataFrame(
        [(s, _ts(ms), t, a, b, c) for s, ms, t, a, b, c in rows],
        "site_id int, end_time timestamp_ntz, type int, avg_tmp double, avg_hmt double, "
        "avg_lx double").withColumn("end_time", F.col("end_time").cast("timestamp"))


def test_rollup_end_label_and_lx_fix(spark):
    day = 86_400_000
    rows = [(1, day, 2, 10.0, 0.1, 100.0),          # hour ending 1970-01-02 00:00
            (1, day - 3_600_000, 2, 20.0, 0.3, 300.0),
            (1, day + 3_600_000, 2, 30.0, 0.5, 500.0)]
    df = _avg_rows(spark, rows)
    by_end = {r.end_time: r for r in rollup(df, 2).collect()}
    # windowed on the end label: the hour ending 00:00 falls into the next day
    first = by_end[_ts(day)]
    assert first.avg_tmp == 20.0 and first.avg_lx == 300.0 and first.type == 3
    second = by_end[_ts(2 * day)]
    assert second.avg_tmp == 20.0 and second.avg_lx == 300.0
    shifted = {r.end_time for r in rollup(df, 2, label_offset_hours=8).collect()}
    assert shifted == {_ts(day + 8 * 3_600_000), _ts(2 * day + 8 * 3_600_000)}
    stamped = {r.end_time: r for r in rollup(df, 2, end_stamped=True).collect()}
    assert stamped[_ts(day)].avg_tmp == 15.0
    assert stamped[_ts(2 * day)].avg_tmp == 30.0


def test_rollup_filters_site_and_range(spark):
    day = 86_400_000
    rows = [(1, day, 2, 10.0, 0.1, 100.0), (2, day, 2, 50.0, 0.1, 100.0),
            (1, 3 * day, 2, 99.0, 0.1, 100.0), (1, day, 3, 77.0, 0.1, 100.0)]
    df = _avg_rows(spark, rows)
    out = rollup(df, 2, site_id=1, start="1970-01-01 00:00:00", end="1970-01-02 00:00:00")
    got = [(r.site_id, r.avg_tmp) for r in out.collect()]
    assert got == [(1, 10.0)]


def test_window_average_label_offset(spark):
    df = spark.createDataFrame([(1, 30_000, 1.0, 0.5, 10.0), (1, 45_000, 3.0, None, 20.0)],
                               "site_id int, timestamp long, tmp double, hmt double, lx double") \
        .withColumn("ts", F.timestamp_millis("timestamp"))
    out = window_averages(df, tier="MINUTE", label_offset_hours=8).collect()
    assert len(out) == 1
    r = out[0]
    assert r.end_time.replace(tzinfo=None) == dt.datetime(1970, 1, 1, 8, 1)
    assert (r.avg_tmp, r.avg_hmt, r.avg_lx, r.type) == (2.0, 0.5, 15.0, 1)


def test_week_windows_start_on_thursday(spark):
    df = spark.createDataFrame([(1, dt.datetime(2023, 4, 2, 12, 0), 1.0, 1.0, 1.0)],
                               "site_id int, ts timestamp, tmp double, hmt double, lx double")
    r = window_averages(df, tier="WEEK").first()
    assert r.end_time.replace(tzinfo=None) == dt.datetime(2023, 4, 6)
