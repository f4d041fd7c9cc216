"""Matcher truth table, single-slot variant, as-of join vs brute force,
and the broadcast size check."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from sitewatch.operators.asof import asof_join
from sitewatch.operators.broadcast import checked_broadcast, measured_bytes
from sitewatch.operators.match import alarms, match_reports, single_slot_match

REPORT_SCHEMA = ("report_id long, site_id int, timestamp long, type string, version int, "
                 "status int, data map<string,double>")
CONFIG_SCHEMA = ("config_id long, site_id int, timestamp long, is_delete int, version int, "
                 "interval int, monitor_items string")


def _rules(**rules):
    return json.dumps({k: {"type": k, "open": o, "max": mx, "min": mn}
                       for k, (o, mx, mn) in rules.items()})


def _configs(spark, rows):
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def _reports(spark, rows):
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def test_truth_table(spark):
    cfg = _configs(spark, [
        (1, 1, 0, 0, 1, 30, _rules(tmp=(1, 10.0, 0.0), hmt=(1, 0.9, 0.1))),
        (2, 2, 0, 1, 1, 30, _rules(tmp=(1, 10.0, 0.0))),            # deleted
        (3, 3, 0, 0, 1, 0, _rules(tmp=(1, 10.0, 0.0))),             # interval off
        (4, 4, 0, 0, 1, 30, _rules(tmp=(0, 10.0, 0.0), lx=(1, 5.0, 1.0))),  # closed rule
        (5, 5, 0, 0, 1, 30, _rules(co2=(1, 1.0, 0.0))),             # sensor absent
        (6, 6, 0, 0, 1, 30, _rules(tmp=(1, None, 0.0))),            # NULL max
        (7, 7, 0, None, 1, None, _rules(tmp=(1, 10.0, 0.0))),       # NULL interval = off
        (8, 9, 0, 0, 1, 30, "not json"),                            # bad rules
    ])
    nan = float("nan")
    rep = _reports(spark, [
        (101, 1, 0, "r", 1, 0, {"tmp": 11.0, "hmt": 0.95}),   # two alarms
        (102, 1, 0, "r", 1, 0, {"tmp": 10.0, "hmt": 0.1}),    # equality is normal
        (103, 1, 0, "r", 1, 0, {"tmp": -0.5}),                # below min
        (104, 1, 0, "r", 1, 0, {"tmp": nan, "hmt": None}),    # NaN and NULL normal
        (105, 1, 0, "r", 1, 1, {"tmp": 5.0}),                 # status never reset
        (106, 1, 0, "r", 1, 0, None),                         # no readings
        (201, 2, 0, "r", 1, 0, {"tmp": 99.0}),
        (301, 3, 0, "r", 1, 0, {"tmp": 99.0}),
        (401, 4, 0, "r", 1, 0, {"tmp": 99.0, "lx": 6.0}),
        (501, 5, 0, "r", 1, 0, {"tmp": 99.0}),
        (601, 6, 0, "r", 1, 0, {"tmp": 99.0}),
        (701, 7, 0, "r", 1, 0, {"tmp": 99.0}),
        (801, 8, 0, "r", 1, 0, {"tmp": 99.0}),                # no config
        (901, 9, 0, "r", 1, 0, {"tmp": 99.0}),
    ])
    m = match_reports(rep, cfg)
    status = {r.report_id: (r.status, len(r.violations)) for r in m.collect()}
    assert status == {101: (1, 2), 102: (0, 0), 103: (1, 1), 104: (0, 0), 105: (1, 0),
                      106: (0, 0), 201: (0, 0), 301: (0, 0), 401: (1, 1), 501: (0, 0),
                      601: (0, 0), 701: (0, 0), 801: (0, 0), 901: (0, 0)}
    a = sorted((r.report_id, r.sensor, r.reading, r.status) for r in alarms(m).collect())
    assert a == [(101, "hmt", 0.95, 1), (101, "tmp", 11.0, 1), (103, "tmp", -0.5, 1),
                 (401, "lx", 6.0, 1)]


def test_latest_config_wins_by_arrival(spark):
    """The last to arrive counts, though its timestamp and version are older."""
    cfg = _configs(spark, [(1, 1, 300, 0, 9, 30, _rules(tmp=(1, 10.0, 0.0))),
                           (2, 1, 200, 1, 2, 30, _rules(tmp=(1, 10.0, 0.0)))])
    rep = _reports(spark, [(1, 1, 0, "r", 1, 0, {"tmp": 20.0})])
    r = match_reports(rep, cfg).first()
    assert r.config_id == 2 and r.status == 0      # the site is switched off


def test_single_slot_ignores_switches(spark):
    cfg = _configs(spark, [(1, 1, 0, 0, 1, 30, _rules(tmp=(1, 1.0, 0.0))),
                           (2, 2, 0, 1, 1, 0, _rules(tmp=(0, 10.0, 0.0)))])
    rep = _reports(spark, [(1, 1, 0, "r", 1, 0, {"tmp": 50.0}),
                           (2, 2, 0, "r", 1, 0, {"tmp": 50.0}),
                           (3, 2, 0, "r", 1, 0, {"tmp": 5.0})])
    got = [(r.report_id, r.sensor) for r in single_slot_match(rep, cfg).collect()]
    assert got == [(2, "tmp")]


def test_asof_join_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    left = [(i, rnd.randint(1, 4), base + dt.timedelta(minutes=rnd.randint(0, 6000)))
            for i in range(400)]
    left += [(900, None, base), (901, 1, None)]
    right = [(1000 + j, rnd.randint(1, 4), base + dt.timedelta(minutes=rnd.randint(0, 6000)))
             for j in range(60)]
    right.append((2000, 1, left[0][2]))          # same instant as a left row
    right.append((2001, 1, left[0][2]))          # tie on time: larger id wins
    ldf = spark.createDataFrame(left, "id long, k int, ts timestamp_ntz") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    rdf = spark.createDataFrame(right, "cid long, k int, ts timestamp_ntz") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    out = asof_join(ldf, rdf, "k", "ts", "ts", "cid", ["cid"], bucket=86_400, prefix="r_")
    got = {r.id: r.r_cid for r in out.collect()}
    measured = asof_join(ldf, rdf, "k", "ts", "ts", "cid", ["cid"], prefix="r_", bucket_rows=3)
    assert {r.id: r.r_cid for r in measured.collect()} == got
    expect = {}
    for i, k, t in left:
        cands = [(rt, cid) for cid, rk, rt in right
                 if k is not None and t is not None and rk == k and rt <= t]
        expect[i] = max(cands)[1] if cands else None
    assert got == expect


def test_checked_broadcast_bounds_bytes(spark):
    """Few rows with long rule maps are too large; the same rows without are not."""
    big = spark.range(1000).withColumnRenamed("id", "k")
    thin = spark.range(10).withColumnRenamed("id", "k")
    fat = thin.withColumn("rules", F.expr("map('tmp', repeat('x', 5000))"))

    def hinted(side):
        plan = big.join(checked_broadcast(side, max_bytes=20_000), "k")
        return "broadcast" in plan._jdf.queryExecution().logical().toString().lower()

    assert hinted(thin) and not hinted(fat)
    assert measured_bytes(fat) > 50_000 and measured_bytes(thin.where("false")) == 0
