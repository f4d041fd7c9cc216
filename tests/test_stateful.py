"""Keyed state: two-stream matcher, config snapshots, ranked windows by timers."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitewatch import fixtures as FX
from sitewatch.functions.json import parse_rules, readings_map
from sitewatch.operators.asof import asof_join
from sitewatch.operators.match import apply_rules
from sitewatch.operators.parse import accepted_reports, annotate_reports
from sitewatch.operators.topn import top_sites_sliding
from sitewatch.sinks.writers import stream_id, write_batch_files
from sitewatch.streaming.stateful import config_snapshots, match_streams, ranked_windows

AVAILABLE_NOW = {"availableNow": True}


def _in_files(df, path, order, files, start=0):
    """Write ``df`` as one parquet file per equal range of ``order``, oldest first."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    step = (high - low) // files + 1
    for i in range(start, files):
        part = df.where((F.col(order) >= low + i * step) & (F.col(order) < low + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(f"{path}/part={i}")
        for name in os.listdir(f"{path}/part={i}"):
            os.utime(f"{path}/part={i}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))


def _stream(spark, path, like):
    return (spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(path))


def _run(stream, out, checkpoint):
    def sink(df, batch_id):
        write_batch_files(df, out, batch_id, stream_id(df))
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(**AVAILABLE_NOW).start())
    q.awaitTermination(600)
    assert q.exception() is None
    return q


def _inputs(spark):
    """Reports arrive by their number, changes half a second after the report of theirs."""
    reports = FX.reports(spark, SF_SMALL).select(
        "report_id", "site_id", "status", "ts", readings_map().alias("data"),
        F.expr("timestamp_seconds(report_id)").alias("arrival"))
    changes = FX.config_changes(spark, SF_SMALL).where("config_id % 3 = 0").select(
        "config_id", "site_id", "is_delete", "interval", "monitor_items",
        F.expr("timestamp_micros(config_id * 1000000 + 500000)").alias("arrival"))
    return reports, changes


def _rows(df):
    return sorted((r.report_id, r.site_id, r.ts, r.config_id, r.status, r.n)
                  for r in df.select("report_id", "site_id", "ts", "config_id", "status",
                                     F.size("violations").alias("n")).collect())


def test_two_streams_equal_the_lookup_in_arrival_order(spark, tmp_dir):
    """Also over a restart with new files, and when the last batch is run again."""
    reports, changes = _inputs(spark)
    joined = asof_join(reports, changes.withColumn("rules", parse_rules("monitor_items")),
                       key="site_id", left_ts="arrival", right_ts="arrival",
                       right_order="config_id", prefix="cfg_",
                       right_cols=["config_id", "is_delete", "interval", "rules"])
    expect = _rows(apply_rules(joined, rules="cfg_rules", is_delete="cfg_is_delete",
                               interval="cfg_interval")
                   .withColumnRenamed("cfg_config_id", "config_id"))
    r, c, out, ckpt = (f"{tmp_dir}/{n}" for n in ("r", "c", "out", "ckpt"))
    limit = reports.count() // 2
    early = (reports.where(F.col("report_id") < limit), changes.where(F.col("config_id") < limit))
    late = (reports.where(F.col("report_id") >= limit), changes.where(F.col("config_id") >= limit))

    def met():
        return match_streams(_stream(spark, r, reports), _stream(spark, c, changes), salts=2)

    for half, (some_reports, some_changes) in enumerate((early, late)):
        _in_files(some_reports.withColumn("_o", F.col("report_id")), f"{r}/{half}", "_o", 2)
        _in_files(some_changes.withColumn("_o", F.col("config_id")), f"{c}/{half}", "_o", 2)
        for path in (f"{r}/{half}", f"{c}/{half}"):   # the second half's files are newer
            for folder, _, names in os.walk(path):
                for n in names:
                    at = os.path.getmtime(f"{folder}/{n}") + 100 * half
                    os.utime(f"{folder}/{n}", (at, at))
        _run(met(), out, ckpt)
    assert _rows(spark.read.parquet(out)) == expect
    assert {x[3] for x in expect if x[3] is not None} and any(x[5] for x in expect)
    last = max(int(n) for n in os.listdir(f"{ckpt}/commits") if n.isdigit())
    for n in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{ckpt}/commits/{n}"):
            os.unlink(f"{ckpt}/commits/{n}")
    _run(met(), out, ckpt)
    assert _rows(spark.read.parquet(out)) == expect


def test_a_config_that_arrived_before_the_held_one_changes_nothing(spark, tmp_dir):
    at = dt.datetime(2024, 1, 1)
    items = json.dumps({"tmp": {"type": "tmp", "open": 1, "max": 1.0, "min": 0.0}})
    reports = spark.createDataFrame(
        [(i, 1, 0, {"tmp": 5.0}, at + dt.timedelta(seconds=s)) for i, s in ((1, 1), (2, 11), (3, 30))],
        "report_id long, site_id int, status int, data map<string,double>, arrival timestamp")
    configs = spark.createDataFrame(
        [(7, 1, 0, 30, items, at + dt.timedelta(seconds=10)),
         (6, 1, 0, 0, items, at + dt.timedelta(seconds=5))],
        "config_id long, site_id int, is_delete int, interval int, monitor_items string, "
        "arrival timestamp")
    _in_files(reports.withColumn("_o", F.col("report_id")), f"{tmp_dir}/r", "_o", 3)
    _in_files(configs.withColumn("_o", -F.col("config_id")), f"{tmp_dir}/c", "_o", 2)
    met = match_streams(_stream(spark, f"{tmp_dir}/r", reports),
                        _stream(spark, f"{tmp_dir}/c", configs), salts=1)
    _run(met, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    got = {r.report_id: (r.config_id, r.status) for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got[1] == (None, 0)                       # before the first config
    assert got[2] == (7, 1) and got[3] == (7, 1)     # 6 came later, but had arrived before 7


def test_a_snapshot_for_every_change(spark, tmp_dir):
    changes = FX.config_changes(spark, SF_SMALL).where("config_id < 60").select(
        "config_id", "site_id", "is_delete", "interval", "monitor_items")
    _in_files(changes.withColumn("_o", F.col("config_id")), f"{tmp_dir}/c", "_o", 2)
    _run(config_snapshots(_stream(spark, f"{tmp_dir}/c", changes)), f"{tmp_dir}/out",
         f"{tmp_dir}/ckpt")
    got = {r.config_id: (r.site_id, {s: c.config_id for s, c in r.snapshot.items()})
           for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    now, expect = {}, {}
    for r in sorted(changes.collect(), key=lambda r: r.config_id):
        now[r.site_id] = r.config_id
        expect[r.config_id] = (r.site_id, dict(now))
    assert got == expect and len(got) == changes.count() > 50


def test_ranked_windows_equal_the_batch_ranking(spark, tmp_dir):
    lines = FX.reports_json(spark, SF_SMALL)
    reports = accepted_reports(annotate_reports(lines))
    small = reports.where("ts < '2024-01-04'").select("site_id", "ts")
    _in_files(small.withColumn("_o", F.unix_seconds("ts")), f"{tmp_dir}/in", "_o", 3)
    stream = _stream(spark, f"{tmp_dir}/in", small).withWatermark("ts", "0 seconds")
    q = _run(ranked_windows(stream, n=3), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    got = {(r.window_end, r.site_id, r.cnt, r.rank)
           for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    mark = dt.datetime.fromisoformat(q.lastProgress["eventTime"]["watermark"].replace("Z", "+00:00"))
    mark = mark.replace(tzinfo=None)
    rows = {(r.window_end, r.site_id, r.cnt, r.rank) for r in top_sites_sliding(small).collect()}
    closed = {r for r in rows if r[0] + dt.timedelta(milliseconds=1) <= mark}
    assert got == closed and len(got) > 100
    # the state of emitted windows is gone: what is left belongs to the last windows
    assert all(op["numRowsTotal"] <= 8 for op in q.lastProgress["stateOperators"])
