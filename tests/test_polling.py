"""The polled table: every row at every poll, offsets that survive a restart."""

import time

from sitewatch.sinks.writers import stream_id, write_batch_files
from sitewatch.sources.polling import PollReader, poll_table

SCHEMA = "site_id int, config_id long, monitor_items string"


def _run(spark, tmp_dir, seconds):
    def sink(df, batch_id):
        write_batch_files(df, f"{tmp_dir}/out", batch_id, stream_id(df))
    q = (poll_table(spark, f"{tmp_dir}/table", SCHEMA, seconds).writeStream.foreachBatch(sink)
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert q.exception() is None


def _polls(spark, tmp_dir):
    out = {}
    for r in spark.read.parquet(f"{tmp_dir}/out").collect():
        out.setdefault(r.poll_time, []).append((r.site_id, r.config_id, r.monitor_items))
    return [sorted(rows, key=str) for _, rows in sorted(out.items())]


def test_every_row_again_and_restarts(spark, tmp_dir):
    first = [(1, 10, "a"), (2, 20, None), (None, 30, "c")]
    spark.createDataFrame(first, SCHEMA).repartition(3).write.parquet(f"{tmp_dir}/table")
    _run(spark, tmp_dir, 2)
    assert _polls(spark, tmp_dir) == [sorted(first, key=str)]
    second = [(1, 11, "b"), (5, 50, "e")]
    spark.createDataFrame(second, SCHEMA).write.mode("overwrite").parquet(f"{tmp_dir}/table")
    time.sleep(2.1)
    _run(spark, tmp_dir, 2)
    polls = _polls(spark, tmp_dir)
    assert polls[0] == sorted(first, key=str) and polls[1:] == [sorted(second, key=str)]


def test_one_poll_for_an_interval(spark, tmp_dir, monkeypatch):
    spark.createDataFrame([(1, 1, "a")], SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/table")
    reader = PollReader(spark.createDataFrame([], SCHEMA).schema, f"{tmp_dir}/table", 30)
    clock = [1000.0]
    monkeypatch.setattr("sitewatch.sources.polling.time.time", lambda: clock[0])
    start = reader.initialOffset()
    assert reader.latestOffset() == {"poll": start["poll"] + 1}
    assert len(reader.partitions(start, reader.latestOffset())) == 1
    committed = reader.latestOffset()
    clock[0] += 15
    assert reader.partitions(committed, reader.latestOffset()) == []   # the same interval
    clock[0] += 300
    late = reader.latestOffset()
    assert late["poll"] == committed["poll"] + 10
    assert len(reader.partitions(committed, late)) == 1                # read once, not ten times
