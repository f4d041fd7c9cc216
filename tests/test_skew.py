"""Hot keys: one site holds a third of all reports. The operators must spread
that site over many tasks instead of funnelling it into one."""

from pyspark.sql import functions as F

from conftest import SF_MID
from sitewatch import fixtures as FX
from sitewatch.functions.json import parse_rules
from sitewatch.operators.asof import asof_join
from sitewatch.operators.latest import current_value
from sitewatch.operators.windows import window_averages


def _hot_reports(spark):
    rep = FX.reports_with_data(spark, SF_MID)
    # every third report goes to site 1 (on top of its own share)
    return rep.withColumn("site_id", F.when(F.col("report_id") % 3 == 0, F.lit(1))
                          .otherwise(F.col("site_id")))


def _spread(df, key_col="site_id", hot=1):
    """Number of output partitions (tasks) holding rows of the hot key."""
    counts = df.rdd.mapPartitions(
        lambda rows: [sum(1 for r in rows if r[key_col] == hot)]).collect()
    return sum(1 for c in counts if c > 0)


def test_asof_splits_hot_site_by_time_bucket(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # keep the 8 shuffle partitions
    try:
        rep = _hot_reports(spark)
        hot_share = rep.where("site_id = 1").count() / rep.count()
        assert hot_share > 0.33
        changes = FX.config_changes(spark, SF_MID).withColumn(
            "rules", parse_rules("monitor_items"))
        out = asof_join(rep, changes, "site_id", "ts", "ts", "config_id",
                        ["config_id"], bucket=86_400, prefix="cfg_")
        assert _spread(out) >= 6
        assert out.count() == rep.count()
        # everything on one day: the measured bucket still spreads the hot site
        one_day = rep.withColumn("ts", F.expr("timestamp_seconds(1704067200 + report_id % 3000)"))
        out = asof_join(one_day, changes, "site_id", "ts", "ts", "config_id",
                        ["config_id"], prefix="cfg_", bucket_rows=200)
        assert _spread(out) >= 6
        assert out.count() == rep.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_asof_partitions_follow_the_rows(spark, monkeypatch):
    """Many rows are dealt by their number, not merged by compressed size."""
    from sitewatch.operators import asof
    monkeypatch.setattr(asof, "FEW_ROWS", 1000)
    monkeypatch.setattr(asof, "TASK_ROWS", 500)
    rep, changes = FX.reports_with_data(spark, SF_MID), FX.config_changes(spark, SF_MID)
    rows = rep.count() + changes.count()
    out = asof_join(rep, changes, "site_id", "ts", "ts", "config_id", ["config_id"], prefix="cfg_")
    assert _spread(out) >= rows // 1000


def test_window_average_splits_hot_site_by_window(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = window_averages(_hot_reports(spark), tier="HOUR")
        assert _spread(out) >= 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_key_is_pre_aggregated(spark):
    """max_by per key runs partially before the shuffle: the hot user reaches
    the exchange as one row per input partition."""
    clicks = FX.clicks(spark, SF_MID).withColumn(
        "user", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user")))
    plan = current_value(clicks, "user", "url", order=("timestamp", "event_id")) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_unbroadcast_match_salts_hot_site(spark):
    """Beyond the broadcast bound the matcher's join is salted: the hot site's
    reports spread over many tasks and the result equals the broadcast one."""
    from sitewatch.operators.match import match_reports
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rep = _hot_reports(spark)
        salted = match_reports(rep, FX.site_configs(spark), max_broadcast_bytes=0)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert _spread(salted) >= 6
        cols = ["report_id", "site_id", "status", "config_id"]
        a = {tuple(r) for r in salted.select(*cols).collect()}
        b = {tuple(r) for r in match_reports(rep, FX.site_configs(spark)).select(*cols).collect()}
        assert a == b and len(a) == rep.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
