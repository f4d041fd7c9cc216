"""Top-N per sliding window: ties, brute force, and the planned top-k cut."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sitewatch.operators.topn import top_sites_sliding


def test_tie_break_by_site(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(s, base + dt.timedelta(seconds=1)) for s in (5, 4, 3, 2, 1)]
    rows += [(5, base + dt.timedelta(seconds=2))]
    df = spark.createDataFrame(rows, "site_id int, ts timestamp")
    out = top_sites_sliding(df, n=3).where(F.col("window_start") == F.lit(base)).orderBy("rank")
    assert [(r.site_id, r.cnt, r.rank) for r in out.collect()] == [(5, 2, 1), (1, 1, 2),
                                                                   (2, 1, 3)]


def test_top3_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.randint(1, 6), base + dt.timedelta(milliseconds=rnd.randint(0, 60_000)))
            for _ in range(500)]
    df = spark.createDataFrame(rows, "site_id int, ts timestamp")
    got = sorted((r.window_start, r.site_id, r.cnt, r.rank)
                 for r in top_sites_sliding(df, n=3).collect())
    counts = defaultdict(Counter)
    for s, t in rows:
        sec = int((t - dt.datetime(1970, 1, 1)).total_seconds() // 5 * 5)
        for k in (0, 1):
            counts[sec - 5 * k][s] += 1
    expect = []
    for start, c in counts.items():
        ranked = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        ws = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=start)
        expect += [(ws, s, n, i + 1) for i, (s, n) in enumerate(ranked)]
    got = [(w.replace(tzinfo=None), s, n, r) for w, s, n, r in got]
    assert got == sorted(expect)


def test_plan_uses_group_limit(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "site_id int, ts timestamp")
    plan = top_sites_sliding(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_two_level_cut_equals_batch_ranking(spark):
    """The streaming form's per-bucket then per-window cut is exact."""
    from conftest import SF_MID
    from sitewatch import fixtures as FX
    from sitewatch.operators.topn import top_n_streaming
    rep = FX.reports(spark, SF_MID)
    cols = ["window_start", "site_id", "cnt", "rank"]
    ranked = {tuple(r) for r in top_sites_sliding(rep, n=3).select(*cols).collect()}
    assert len(ranked) > 1000
    for levels in ((3,), (6, 2), (64, 8, 2)):
        cut = {tuple(r) for r in top_n_streaming(rep, n=3, levels=levels).select(*cols).collect()}
        assert cut == ranked, levels
    with pytest.raises(ValueError):
        top_n_streaming(rep, levels=(64, 6))
