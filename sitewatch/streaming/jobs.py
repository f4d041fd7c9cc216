"""Structured Streaming jobs assembled from the batch operators.

monitor_stream   parse -> quarantine -> latest config (re-read per batch) ->
                 match -> alarms / annotated reports / archive  (foreachBatch)
alarm_log        reports + config changes, both streams -> match -> exactly-once alarm log
average_stream   watermark -> tumbling averages (append) -> keyed upsert
topn_stream      sliding counts -> per-window top N (chained aggregations)
config_changelog current config per site (complete mode)
file_stream      any stream -> one folder per run and batch

Every query has a checkpoint of its own: the given one, or one under the shared
``spark.checkpoint.dir`` named after the job, its source and its output. File
outputs are keyed by the query's id and the batch id, so a replayed batch replaces
itself and a query started anew keeps what was written before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sitewatch import schemas as S
from sitewatch.operators.latest import latest_per_key
from sitewatch.operators.match import ARRIVAL, alarms, match_reports
from sitewatch.operators.parse import (accepted_reports, annotate_reports,
                                       rejected_reports)
from sitewatch.operators.topn import top_n_streaming
from sitewatch.operators.windows import window_averages
from sitewatch.session import checkpoint_root, use_state_store
from sitewatch.sinks.once_log import ROLL_BYTES, log_stream
from sitewatch.sinks.records import alarm_records, archive_records
from sitewatch.sinks.writers import (AVG_PARTITIONS, print_rows, stream_id, upsert_table,
                                     with_avg_partitions, write_archive, write_batch_files)
from sitewatch.streaming.stateful import SALTS, match_streams

EVERY_5_S = {"processingTime": "5 seconds"}


def checkpoint_location(spark: SparkSession, job: str, given: str | None,
                        source: str | None, output: str | None) -> str:
    """``given``, or a folder that depends on the job, its source and its output, so
    that no two queries share one."""
    if given:
        return given
    if not source or not output:
        raise ValueError(f"{job}: give a checkpoint, or the source and output to name one by")
    digest = hashlib.sha256(f"{source}\n{output}".encode()).hexdigest()[:24]
    return f"{checkpoint_root(spark)}/streams/{job}-{digest}"


def monitor_batch(batch: DataFrame, batch_id: int, config_loader: Callable[[], DataFrame],
                  out_dir: str, run_id: str, archive: bool = True, strict: bool = False,
                  alarm_writer: Callable[[DataFrame, int], None] | None = None) -> None:
    """One micro-batch of the monitor: the annotated batch is persisted once
    and feeds every output; each output is written under its run and batch id."""
    annotated = annotate_reports(batch, strict=strict).persist()
    configs = config_loader().persist()   # read once: measured, then broadcast
    try:
        reports = accepted_reports(annotated)
        matched = match_reports(reports, configs).persist()
        try:
            alarm_rows = alarm_records(alarms(matched))
            if alarm_writer is not None:
                alarm_writer(alarm_rows, batch_id)
            else:
                write_batch_files(alarm_rows, f"{out_dir}/alarms", batch_id, run_id, "text")
            write_batch_files(matched.drop("violations"), f"{out_dir}/reports", batch_id, run_id)
            write_batch_files(rejected_reports(annotated), f"{out_dir}/quarantine", batch_id,
                              run_id)
            if archive:
                write_archive(archive_records(matched), f"{out_dir}/archive", batch_id, run_id)
        finally:
            matched.unpersist()
    finally:
        configs.unpersist()
        annotated.unpersist()


def monitor_stream(spark: SparkSession, lines: DataFrame,
                   config_loader: Callable[[], DataFrame], out_dir: str,
                   checkpoint: str | None = None, trigger: dict | None = None,
                   source: str | None = None, **kw) -> StreamingQuery:
    """The streaming monitor (SRC-1 + PRJ-1/2 + JN-1..4 + SNK-1/3/5).

    ``config_loader`` re-reads the config table on every micro-batch (the
    poll of the reference, at the trigger interval). ``source`` names the input.
    """
    def run(df: DataFrame, batch_id: int) -> None:
        monitor_batch(df, batch_id, config_loader, out_dir, stream_id(df), **kw)

    w = lines.writeStream.foreachBatch(run).option(
        "checkpointLocation", checkpoint_location(spark, "monitor", checkpoint, source, out_dir))
    return w.trigger(**(trigger or EVERY_5_S)).start()


def alarm_log(reports: DataFrame, configs: DataFrame, path: str, checkpoint: str,
              trigger: dict | None = None, salts: int = SALTS,
              roll_bytes: int = ROLL_BYTES) -> StreamingQuery:
    """Reports and config changes as two streams (JN-1..4, SRC-4, ST-11): every alarm reaches
    the log at ``path`` exactly once (SNK-1). Both have their time of ``arrival``."""
    matched = match_streams(reports, configs, salts=salts)
    return log_stream(alarm_records(alarms(matched)), path, checkpoint, trigger or EVERY_5_S,
                      roll_bytes)


def average_stream(spark: SparkSession, reports: DataFrame, table_path: str | None, tier=1,
                   watermark: str = "0 seconds", checkpoint: str | None = None,
                   trigger: dict | None = None, ts: str = "ts", source: str | None = None,
                   writer: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Streaming AGG-1 + SNK-2: windows are emitted once the watermark passes
    their end (append mode) and upserted into the averaged-tier table,
    partitioned by (type, end_date, end_hour) so each batch rewrites only the
    hours it touches. ``writer`` replaces the table (e.g. a database upsert)."""
    t = S.tier(tier)
    use_state_store(spark)
    averaged = window_averages(reports.withWatermark(ts, watermark), tier=t, ts=ts)

    def sink(df: DataFrame, batch_id: int) -> None:
        if writer is not None:
            writer(df, batch_id)
        else:
            upsert_table(df.sparkSession, with_avg_partitions(df), table_path, S.AVG_KEYS,
                         partition_by=AVG_PARTITIONS)

    w = averaged.writeStream.outputMode("append").foreachBatch(sink).option(
        "checkpointLocation", checkpoint_location(spark, f"avg_{t.name.lower()}", checkpoint,
                                                  source, table_path))
    return w.trigger(**(trigger or EVERY_5_S)).start()


def topn_stream(reports: DataFrame, n: int = 3, size: str = "10 seconds",
                slide: str = "5 seconds", watermark: str = "0 seconds",
                ts: str = "ts", **kw) -> DataFrame:
    """Streaming TOP-1 (append mode): start it with any sink."""
    return top_n_streaming(reports.withWatermark(ts, watermark), n, size, slide, ts, **kw)


def config_changelog(configs: DataFrame, key: str = "site_id", order=ARRIVAL) -> DataFrame:
    """AGG-8 / ST-10: current config per site, the last to arrive; write it in
    complete mode to re-emit the whole current table on every trigger."""
    return latest_per_key(configs, key, order)


def file_stream(stream: DataFrame, out_dir: str, job: str, mode: str = "append",
                checkpoint: str | None = None, source: str | None = None,
                trigger: dict | None = None, show: bool = False) -> StreamingQuery:
    """Write every batch's rows, all of them, under ``out_dir/run=<id>/batch_id=<n>``;
    ``show`` also prints them."""
    spark = use_state_store(stream.sparkSession)

    def sink(df: DataFrame, batch_id: int) -> None:
        write_batch_files(df, out_dir, batch_id, stream_id(df))
        if show:
            print_rows(df, f"{job}, batch {batch_id}")

    w = stream.writeStream.outputMode(mode).foreachBatch(sink).option(
        "checkpointLocation", checkpoint_location(spark, job, checkpoint, source, out_dir))
    return w.trigger(**(trigger or EVERY_5_S)).start()


def state_size(query: StreamingQuery) -> list[dict]:
    """Rows and bytes of state of each stateful operator after the last batch, and the rows
    it dropped as late."""
    progress = query.lastProgress
    return [{"operator": op["operatorName"], "rows": op["numRowsTotal"],
             "bytes": op["memoryUsedBytes"], "late": op["numRowsDroppedByWatermark"]}
            for op in (progress["stateOperators"] if progress else [])]
