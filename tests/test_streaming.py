"""Streaming forms equal the batch forms; sinks replay idempotently."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitewatch import fixtures as FX
from sitewatch.operators.match import alarms, match_reports
from sitewatch.operators.parse import accepted_reports, annotate_reports
from sitewatch.operators.topn import top_sites_sliding
from sitewatch.operators.windows import window_averages
from sitewatch.sinks import writers
from sitewatch.sinks.writers import read_table, upsert_table
from sitewatch.streaming.jobs import (average_stream, checkpoint_location, config_changelog,
                                      file_stream, monitor_batch, monitor_stream, state_size,
                                      topn_stream)

AVAILABLE_NOW = {"availableNow": True}


def _write_lines(spark, sf_dir, path, parts=3):
    """Report lines as ``parts`` files in event-time order, written one after
    another (a stream delivers them in this order)."""
    lines = FX.reports_json(spark, sf_dir).withColumn(
        "_t", F.coalesce(F.get_json_object("value", "$.timestamp").try_cast("long"), F.lit(0)))
    lines = lines.withColumn("_part", F.ntile(parts).over(Window.orderBy("_t", "value")))
    for i in range(1, parts + 1):
        lines.where(F.col("_part") == i).select("value").coalesce(1) \
            .write.mode("append").text(path)
        time.sleep(1.1)


def _reports_stream(spark, path):
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(path)
    return accepted_reports(annotate_reports(lines))


def _watermark(q):
    """The watermark that the query's last batch ran with."""
    text = q.lastProgress["eventTime"]["watermark"]
    return dt.datetime.fromisoformat(text.replace("Z", ""))


def test_monitor_stream_equals_batch(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    _write_lines(spark, SF_SMALL, src)
    cfg = FX.site_configs(spark)
    q = monitor_stream(spark, spark.readStream.format("text").load(src), lambda: cfg, out,
                       checkpoint=f"{tmp_dir}/ckpt", trigger=AVAILABLE_NOW)
    q.awaitTermination(300)
    assert q.exception() is None
    streamed = spark.read.text(f"{out}/alarms").count()
    batch = alarms(match_reports(
        accepted_reports(annotate_reports(FX.reports_json(spark, SF_SMALL))), cfg)).count()
    assert streamed == batch > 0
    annotated = annotate_reports(FX.reports_json(spark, SF_SMALL))
    kept = accepted_reports(annotated).count()
    assert spark.read.parquet(f"{out}/reports").count() == kept
    assert spark.read.parquet(f"{out}/quarantine").count() == annotated.count() - kept > 0
    archived = spark.read.text(f"{out}/archive")
    assert archived.count() == kept
    assert archived.select("day").distinct().count() <= 2   # the day of writing


def test_monitor_batch_replay_is_idempotent(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    lines = FX.reports_json(spark, SF_SMALL)
    cfg = FX.site_configs(spark)
    monitor_batch(lines, 7, lambda: cfg, out, "a")
    first = spark.read.text(f"{out}/alarms").count()
    monitor_batch(lines, 7, lambda: cfg, out, "a")
    assert spark.read.text(f"{out}/alarms").count() == first
    accepted = accepted_reports(annotate_reports(lines)).count()
    assert accepted > 1000
    assert spark.read.text(f"{out}/archive").count() == accepted


def test_archive_replayed_on_another_day_leaves_one_copy(spark, tmp_dir):
    rows = spark.createDataFrame([("{}",)] * 3, "value string")
    for day in ("2024-01-31", "2024-02-01"):
        writers.write_archive(rows.withColumn("day", F.lit(day)), f"{tmp_dir}/a", 5, "run1")
    got = spark.read.text(f"{tmp_dir}/a").collect()
    assert len(got) == 3 and {str(r.day) for r in got} == {"2024-02-01"}


def test_fresh_checkpoint_keeps_earlier_output(spark, tmp_dir):
    """A job started anew counts its batches from 0 again: nothing is replaced."""
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    cfg = FX.site_configs(spark)
    line = ('{"siteId":1,"timestamp":%d,"type":"report","version":1,"status":0,'
            '"data":{"tmp":500.0}}')
    for run, ts in (("first", 1), ("second", 2)):
        spark.createDataFrame([(line % ts,)], "value string").coalesce(1) \
            .write.mode("overwrite").text(src)
        q = monitor_stream(spark, spark.readStream.format("text").load(src), lambda: cfg, out,
                           checkpoint=f"{tmp_dir}/ckpt-{run}", trigger=AVAILABLE_NOW)
        q.awaitTermination(300)
        assert q.exception() is None
    stamps = {r.timestamp for r in spark.read.parquet(f"{out}/reports").collect()}
    assert stamps == {1, 2}
    assert len(os.listdir(f"{out}/reports")) == 2


def test_default_checkpoints_differ_by_input_and_output(spark):
    where = {checkpoint_location(spark, "monitor", None, s, o)
             for s in ("kafka:h/a", "kafka:h/b") for o in ("/x", "/y")}
    assert len(where) == 4
    assert checkpoint_location(spark, "monitor", "/given", None, None) == "/given"
    with pytest.raises(ValueError):
        checkpoint_location(spark, "monitor", None, None, "/x")


def test_average_stream_upserts_closed_windows(spark, tmp_dir):
    src, table = f"{tmp_dir}/in", f"{tmp_dir}/tier"
    _write_lines(spark, SF_SMALL, src)
    q = average_stream(spark, _reports_stream(spark, src), table, tier="HOUR",
                       checkpoint=f"{tmp_dir}/ckpt", trigger=AVAILABLE_NOW)
    q.awaitTermination(300)
    assert q.exception() is None
    streamed = read_table(spark, table)
    batch = window_averages(accepted_reports(annotate_reports(FX.reports_json(spark, SF_SMALL))),
                            tier="HOUR")
    cols = ["site_id", "end_time", "avg_tmp", "avg_hmt", "avg_lx"]
    s = {tuple(r) for r in streamed.select(*cols).collect()}
    b = {tuple(r) for r in batch.select(*cols).collect()}
    # append mode keeps the windows still open at the final watermark
    closed = {r for r in b if r[1] <= _watermark(q)}
    assert s == closed and 0 < len(closed) < len(b)


def test_average_stream_restarts_with_its_state(spark, tmp_dir):
    """Windows open when the query stops are whole after the restart; state is in RocksDB."""
    src, table, ckpt = (f"{tmp_dir}/{n}" for n in ("in", "avg", "ckpt"))
    reports = FX.reports_wire(spark, SF_SMALL).withColumn(
        "t", F.get_json_object("value", "$.timestamp").cast("long"))
    middle = reports.agg(F.percentile("t", 0.5)).first()[0]

    def run(part):
        part.select("value").coalesce(1).write.mode("append").text(src)
        q = average_stream(spark, _reports_stream(spark, src), table, tier="DAY",
                           checkpoint=ckpt, trigger=AVAILABLE_NOW)
        q.awaitTermination(300)
        assert q.exception() is None
        return q

    size = state_size(run(reports.where(F.col("t") < middle)))
    assert size and all(s["rows"] >= 0 and s["bytes"] >= 0 for s in size)
    assert any(s["rows"] > 0 for s in size)
    q = run(reports.where(F.col("t") >= middle))
    cols = ["site_id", "end_time", "avg_tmp", "avg_hmt", "avg_lx"]
    got = {tuple(r) for r in read_table(spark, table).select(*cols).collect()}
    whole = window_averages(accepted_reports(annotate_reports(reports)), tier="DAY")
    assert got == {tuple(r) for r in whole.select(*cols).collect() if r.end_time <= _watermark(q)}
    stores = [f for _, _, names in os.walk(f"{ckpt}/state") for f in names]
    assert any(f.endswith((".changelog", ".zip")) for f in stores)


def test_average_stream_takes_any_reading(spark, tmp_dir):
    """One absurd sensor value neither ends the stream nor touches other windows."""
    base = 1_700_000_040_000
    lines = [f'{{"siteId":1,"timestamp":{base + t},"type":"report","version":1,"status":0,'
             f'"data":{{"tmp":{v}}}}}'
             for t, v in ((0, 1e30), (1, 2e-11), (2, -1e30), (60_000, 2e-11), (600_000, 1.0))]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/in")
    q = average_stream(spark, _reports_stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/avg",
                       checkpoint=f"{tmp_dir}/ckpt", trigger=AVAILABLE_NOW)
    q.awaitTermination(300)
    assert q.exception() is None
    got = sorted((r.end_time, r.avg_tmp) for r in read_table(spark, f"{tmp_dir}/avg").collect())
    assert [v for _, v in got] == [2e-11 / 3, 2e-11]


def test_upsert_table_replay(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    rows = spark.createDataFrame([(1, 1, 1.0), (2, 1, 2.0), (3, 2, 3.0)],
                                 "k int, type int, v double")
    upsert_table(spark, rows, table, ["k"], partition_by=("type",))
    upd = spark.createDataFrame([(2, 1, 20.0), (4, 1, 40.0)], "k int, type int, v double")
    upsert_table(spark, upd, table, ["k"], partition_by=("type",))
    upsert_table(spark, upd, table, ["k"], partition_by=("type",))
    got = sorted((r.k, r.v) for r in read_table(spark, table).collect())
    assert got == [(1, 1.0), (2, 20.0), (3, 3.0), (4, 40.0)]


def _table_rows(spark, table):
    return sorted((r.k, r.v) for r in read_table(spark, table).collect())


def test_upsert_crash_between_steps_loses_nothing(spark, tmp_dir, monkeypatch):
    """Stop the upsert before, between and after its switches; readers see every old
    row throughout and the replay gives the whole result."""
    schema = "k int, type int, v double"
    old = spark.createDataFrame([(1, 1, 1.0), (2, 1, 2.0), (3, 2, 3.0)], schema)
    upd = spark.createDataFrame([(2, 1, 20.0), (3, 2, 30.0), (4, 1, 40.0)], schema)
    switch = writers._switch
    for stop_after in (0, 1):
        table = f"{tmp_dir}/t{stop_after}"
        upsert_table(spark, old, table, ["k"])
        done = []

        def failing(*a):
            if len(done) == stop_after:
                raise RuntimeError("crash")
            done.append(a)
            return switch(*a)

        monkeypatch.setattr(writers, "_switch", failing)
        with pytest.raises(RuntimeError):
            upsert_table(spark, upd, table, ["k"])
        monkeypatch.setattr(writers, "_switch", switch)
        assert {k for k, _ in _table_rows(spark, table)} >= {1, 2, 3}
        upsert_table(spark, upd, table, ["k"])
        assert _table_rows(spark, table) == [(1, 1.0), (2, 20.0), (3, 30.0), (4, 40.0)]


def test_upsert_reads_only_touched_partitions_once(spark, tmp_dir, monkeypatch):
    table = f"{tmp_dir}/t"
    rows = spark.range(300).selectExpr("CAST(id AS INT) AS k", "CAST(id % 30 AS INT) AS type",
                                       "CAST(id AS DOUBLE) AS v")
    upsert_table(spark, rows, table, ["k"])
    listed, read = [], []
    folders = writers._Files.folders
    monkeypatch.setattr(writers._Files, "folders",
                        lambda self, p: (listed.append(p), folders(self, p))[1])
    merge = writers.upsert
    monkeypatch.setattr(writers, "upsert",
                        lambda cur, upd, keys: (read.extend(cur.inputFiles()),
                                                merge(cur, upd, keys))[1])
    calls = spark.sparkContext.accumulator(0)

    def seen(it):
        for b in it:
            calls.add(b.num_rows)
            yield b

    upd = spark.createDataFrame([(3, 3, -1.0), (7, 7, -1.0)], "k int, type int, v double")
    upsert_table(spark, upd.mapInArrow(seen, upd.schema), table, ["k"])
    assert calls.value == 2                     # the updates were computed once
    assert read and all("/type=3/" in f or "/type=7/" in f for f in read)
    assert {p for p in listed if "_staging" not in p} == {f"{table}/type=3", f"{table}/type=7"}
    assert read_table(spark, table).count() == 300


def test_table_read_lists_only_kept_partitions(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    assert read_table(spark, table) is None
    rows = spark.createDataFrame([(1, 1, 1.0), (2, 2, 2.0)], "k int, type int, v double")
    upsert_table(spark, rows, table, ["k"])
    only = read_table(spark, table, lambda column, value: value == "2")
    assert [r.k for r in only.collect()] == [2]


def test_topn_stream_equals_batch(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _write_lines(spark, SF_SMALL, src)
    top = topn_stream(_reports_stream(spark, src), n=3)
    q = (top.writeStream.outputMode("append").format("memory").queryName("top3_stream")
            .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    s = {(r.window_end, r.site_id, r.cnt, r.rank)
         for r in spark.sql("SELECT * FROM top3_stream").collect()}
    b = {(r.window_end, r.site_id, r.cnt, r.rank) for r in top_sites_sliding(
        accepted_reports(annotate_reports(FX.reports_json(spark, SF_SMALL)))).collect()}
    closed = {r for r in b if r[0] <= _watermark(q)}
    assert s == closed and len(closed) > 1000


def test_file_stream_writes_every_row(spark, tmp_dir):
    """More rows in a batch than a console shows: all are in the output."""
    src = f"{tmp_dir}/in"
    spark.range(500).selectExpr("CAST(id AS STRING) AS value").coalesce(1).write.text(src)
    q = file_stream(spark.readStream.format("text").load(src), f"{tmp_dir}/out", "copy",
                    checkpoint=f"{tmp_dir}/ckpt", trigger=AVAILABLE_NOW)
    q.awaitTermination(300)
    assert q.exception() is None
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 500


def test_config_changelog_complete_mode(spark, tmp_dir):
    src = f"{tmp_dir}/cfg"
    FX.config_changes(spark, SF_SMALL).write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (config_changelog(stream).writeStream.outputMode("complete").format("memory")
         .queryName("cfg_now").option("checkpointLocation", f"{tmp_dir}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {r.site_id: r.config_id for r in spark.sql("SELECT * FROM cfg_now").collect()}
    latest = (FX.config_changes(spark, SF_SMALL).groupBy("site_id")
              .agg(F.max("config_id").alias("c"), F.max_by("config_id", "ts").alias("newest")))
    latest = latest.collect()
    assert got == {r.site_id: r.c for r in latest}
    assert any(r.c != r.newest for r in latest)   # arrival order is not time order
    assert len(got) == FX.N_SITES


def test_archive_without_day_folders(spark, tmp_dir):
    from sitewatch.sinks.records import archive_records
    from sitewatch.sinks.writers import write_archive
    rec = archive_records(FX.reports_with_data(spark, SF_SMALL), bucket_time="event")
    write_archive(rec, f"{tmp_dir}/flat", 3, "r", by_day=False)
    write_archive(rec, f"{tmp_dir}/flat", 3, "r", by_day=False)
    assert os.listdir(f"{tmp_dir}/flat/run=r") == ["batch_id=3"]
    assert spark.read.text(f"{tmp_dir}/flat").count() == 1000
    write_archive(rec, f"{tmp_dir}/days")
    days = [d for d in os.listdir(f"{tmp_dir}/days") if d.startswith("day=")]
    assert len(days) == 30


def test_config_is_reread_every_batch(spark, tmp_dir):
    """SRC-2: the config table is polled per micro-batch; a change applies to
    the next batch (site 2's threshold is lowered between the two batches)."""
    import json as _json
    out = f"{tmp_dir}/out"
    lines = FX.reports_json(spark, SF_SMALL)
    rules = lambda mx: _json.dumps({"tmp": {"type": "tmp", "open": 1, "max": mx,
                                            "min": 0.0}})
    schema = ("config_id long, site_id int, timestamp long, is_delete int, version int, "
              "interval int, monitor_items string")
    versions = iter([FX.literal_rows(spark, [(1, 2, 0, 0, 1, 30, rules(1000.0))], schema),
                     FX.literal_rows(spark, [(2, 2, 0, 0, 2, 30, rules(1.0))], schema)])
    loader = lambda: next(versions)
    monitor_batch(lines, 0, loader, out, "a", archive=False)
    monitor_batch(lines, 1, loader, out, "a", archive=False)
    first = spark.read.text(f"{out}/alarms/run=a/batch_id=0").count()
    second = spark.read.text(f"{out}/alarms/run=a/batch_id=1").count()
    assert first == 0 and second > 0


def test_late_report_is_dropped(spark, tmp_dir):
    """ST-8: no allowed lateness. A report whose window was already emitted
    (its end is behind the watermark of an earlier micro-batch) is dropped
    and does not change the stored average. Spark filters with the previous
    batch's watermark, so lateness is judged one micro-batch behind."""
    src, table = f"{tmp_dir}/in", f"{tmp_dir}/tier"
    line = ('{{"siteId":1,"timestamp":{ts},"type":"report","version":1,"status":0,'
            '"data":{{"tmp":{v},"hmt":0.5,"lx":1.0}}}}')
    hour = 3_600_000
    batches = [[line.format(ts=0, v=10.0), line.format(ts=2 * hour, v=30.0)],
               [line.format(ts=4 * hour, v=50.0)],
               [line.format(ts=60_000, v=1000.0), line.format(ts=6 * hour, v=70.0)]]
    for rows in batches:
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1) \
            .write.mode("append").text(src)
        time.sleep(1.1)
    q = average_stream(spark, _reports_stream(spark, src), table, tier="HOUR",
                       checkpoint=f"{tmp_dir}/ckpt", trigger=AVAILABLE_NOW)
    q.awaitTermination(300)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    got = {r.end_time.hour: r.avg_tmp for r in read_table(spark, table).collect()}
    assert got[1] == 10.0 and dropped >= 1   # the late 1000.0 did not reopen hour 1
    assert got[3] == 30.0 and got[5] == 50.0
