"""Command-line entry points for the monitoring jobs (spark-submit friendly).

  rollup    tier t -> t+1 of the averaged table, for one site or all sites, in a
            time range (the reference's ``--siteId --start --end --type``)
  averages  streaming tumbling averages of the report stream into the table
  compact   merge the batches of an averaged table that is merged when read
  alarms    reports and config changes as two streams; alarms into an exactly-once log
  monitor   streaming parse + match + alarms + archive
  topn      streaming top-N sites per sliding window, into a folder
  changelog current config per site from the config topic, into a folder
  purge     drop tiers from the averaged table (``delete ... where type in``)

The averaged table is parquet partitioned by (type, end_date, end_hour), or a
database table (``--jdbc-url``); writes are keyed upserts, so re-running a job gives
the same table. The config topic must be keyed by site: a site's changes then lie in
one partition, whose offsets are their order of arrival.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from sitewatch import schemas as S
from sitewatch.operators.parse import (accepted_reports, annotate_reports,
                                       parse_config_messages)
from sitewatch.operators.windows import rollup
from sitewatch.session import get_spark
from sitewatch.sinks.merge_table import MergeTable
from sitewatch.sinks.writers import (AVG_PARTITIONS, purge_table, read_table, staging_name,
                                     stream_id, tier_folders, upsert_table,
                                     with_avg_partitions, write_jdbc_upsert, write_kafka)
from sitewatch.sources.readers import (read_config_changes, read_config_snapshot,
                                       read_jdbc_table, read_kafka, read_text, read_tier)
from sitewatch.streaming.jobs import (alarm_log, average_stream, checkpoint_location,
                                      config_changelog, file_stream, monitor_stream,
                                      topn_stream)

AVG_TABLE = "dev_avg_data"
CONFIG_TABLE = "dev_monitor_config"


def run_rollup(spark, table: str, tier_code: int, site_id=None, start=None, end=None,
               output: str | None = None, label_offset_hours: int = 0,
               end_stamped: bool = False, jdbc_url: str | None = None,
               jdbc_properties: dict | None = None) -> None:
    """One rollup job; with ``jdbc_url`` the tables are those of the database."""
    if jdbc_url:
        src = read_jdbc_table(spark, jdbc_url, table, jdbc_properties)
    else:
        src = read_table(spark, table, tier_folders(tier_code, start, end))
    if src is None:
        raise ValueError(f"no averaged table at {table}")
    scan = read_tier(src, site_id=site_id, start=start, end=end, tier_code=tier_code)
    out = rollup(scan, tier_code, label_offset_hours=label_offset_hours,
                 end_stamped=end_stamped)
    if jdbc_url:
        write_jdbc_upsert(out, jdbc_url, output or table, S.AVG_KEYS, jdbc_properties)
    else:
        upsert_table(spark, with_avg_partitions(out), output or table, S.AVG_KEYS,
                     partition_by=AVG_PARTITIONS)


def _lines(spark, args):
    """Report text from Kafka (latest offsets, bounded batches) or a folder."""
    if args.kafka:
        opts = {}
        if getattr(args, "max_offsets_per_trigger", None):
            opts["maxOffsetsPerTrigger"] = str(args.max_offsets_per_trigger)
        return read_kafka(spark, args.kafka, args.topic, starting_offsets="latest",
                          options=opts).select("value")
    return read_text(spark, args.reports, streaming=True,
                     max_files_per_trigger=getattr(args, "max_files_per_trigger", None))


def _source(args) -> str:
    """What names the input in a derived checkpoint location."""
    return f"kafka:{args.kafka}/{args.topic}" if args.kafka else f"files:{args.reports}"


def _properties(args) -> dict:
    return dict(p.partition("=")[::2] for p in args.jdbc_property)


def _stream_input_args(parser):
    parser.add_argument("--reports", help="folder of report text files (stream)")
    parser.add_argument("--kafka", help="bootstrap servers of the report topic")
    parser.add_argument("--topic", default="report")
    parser.add_argument("--max-offsets-per-trigger", type=int,
                        help="bound each micro-batch (Kafka backlog)")
    parser.add_argument("--max-files-per-trigger", type=int,
                        help="bound each micro-batch (file source)")
    parser.add_argument("--checkpoint", help="default: named after input and output")
    parser.add_argument("--trigger", default="5 seconds")
    parser.add_argument("--available-now", action="store_true",
                        help="process what is there, then stop")


def _jdbc_args(parser):
    parser.add_argument("--jdbc-url", help="use a database table instead")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE",
                        help="connection property (user, password, driver), repeatable")


def _trigger(args) -> dict:
    return {"availableNow": True} if args.available_now else {"processingTime": args.trigger}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sitewatch")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("rollup")
    r.add_argument("--table", default=AVG_TABLE, help="folder, or database table")
    r.add_argument("--output")
    r.add_argument("--type", type=int, required=True, help="source tier code (1..4)")
    r.add_argument("--siteId", type=int)
    r.add_argument("--start")
    r.add_argument("--end")
    r.add_argument("--label-offset-hours", type=int, default=0)
    r.add_argument("--end-stamped", action="store_true")
    _jdbc_args(r)

    a = sub.add_parser("averages")
    _stream_input_args(a)
    _jdbc_args(a)
    a.add_argument("--table", default=AVG_TABLE, help="folder, or database table")
    a.add_argument("--tier", default="MINUTE")
    a.add_argument("--watermark", default="0 seconds")
    a.add_argument("--merge-on-read", action="store_true",
                   help="a table that batches add to and readers merge")

    k = sub.add_parser("compact", help="merge the batches of a merge-on-read averaged table")
    k.add_argument("--table", required=True)

    n = sub.add_parser("alarms", help="match reports against a stream of config changes")
    _stream_input_args(n)
    n.add_argument("--config-kafka", help="bootstrap servers of the config topic")
    n.add_argument("--config-topic", default="config")
    n.add_argument("--configs", help="folder of config messages, one JSON line each (stream)")
    n.add_argument("--out", required=True, help="folder of the exactly-once alarm log")

    m = sub.add_parser("monitor")
    _stream_input_args(m)
    _jdbc_args(m)
    m.add_argument("--config", default=CONFIG_TABLE,
                   help="config table: parquet path, or database table")
    m.add_argument("--out", required=True)
    m.add_argument("--no-archive", action="store_true")
    m.add_argument("--strict", action="store_true")
    m.add_argument("--alarm-kafka", help="bootstrap servers for the alarm topic")
    m.add_argument("--alarm-topic", default="alarm")

    t = sub.add_parser("topn")
    _stream_input_args(t)
    t.add_argument("--out", required=True)
    t.add_argument("--print", action="store_true", help="also print every row")
    t.add_argument("-n", type=int, default=3)
    t.add_argument("--size", default="10 seconds")
    t.add_argument("--slide", default="5 seconds")
    t.add_argument("--watermark", default="0 seconds")
    t.add_argument("--site-buckets", type=int, nargs="+", default=[4096, 64],
                   help="buckets of each level of the cut, each a divisor of the one before")

    c = sub.add_parser("changelog")
    c.add_argument("--kafka", required=True)
    c.add_argument("--topic", default="config", help="must be keyed by site")
    c.add_argument("--out", required=True)
    c.add_argument("--print", action="store_true", help="also print every row")
    c.add_argument("--checkpoint", help="default: named after input and output")

    g = sub.add_parser("purge")
    g.add_argument("--table", required=True)
    g.add_argument("--types", type=int, nargs="+", default=[1, 2])
    return p


def averaged_table(spark, path: str) -> MergeTable:
    """The averaged table in its merge-on-read form."""
    return MergeTable(spark, path, S.AVG_KEYS, S.AVG_ROW)


def _arriving(spark, kafka, topic, folder, max_files=None):
    """Text with its time of arrival: a record's, or its file's (and a record's offset)."""
    if kafka:
        return read_kafka(spark, kafka, topic, starting_offsets="earliest").selectExpr(
            "value", "kafka_ts AS arrival", "offset AS config_id")
    return read_text(spark, folder, streaming=True, max_files_per_trigger=max_files).selectExpr(
        "value", "_metadata.file_modification_time AS arrival", "0L AS config_id")


def _alarms(spark, args):
    lines = _arriving(spark, args.kafka, args.topic, args.reports, args.max_files_per_trigger)
    reports = accepted_reports(annotate_reports(lines), keep=("arrival",))
    configs = parse_config_messages(
        _arriving(spark, args.config_kafka, args.config_topic, args.configs),
        keep=("config_id", "arrival"))
    if not args.config_kafka:  # messages of one file arrive together: their own time decides
        configs = configs.withColumn("config_id", F.col("timestamp"))
    checkpoint = checkpoint_location(spark, "alarms", args.checkpoint, _source(args), args.out)
    return alarm_log(reports, configs, args.out, checkpoint, _trigger(args))


def _averages(spark, args):
    reports = accepted_reports(annotate_reports(_lines(spark, args)))
    output, writer = args.table, None
    if args.merge_on_read:
        writer = averaged_table(spark, args.table).batch_writer()
    if args.jdbc_url:
        output = f"{args.jdbc_url}/{args.table}"

        def writer(df, batch_id):
            write_jdbc_upsert(df, args.jdbc_url, args.table, S.AVG_KEYS, _properties(args),
                              staging_name(args.table, stream_id(df), batch_id))
    return average_stream(spark, reports, output, tier=args.tier, watermark=args.watermark,
                          checkpoint=args.checkpoint, trigger=_trigger(args),
                          source=_source(args), writer=writer)


def _monitor(spark, args):
    alarm_writer = None
    if args.alarm_kafka:
        def alarm_writer(rows, batch_id):
            write_kafka(rows, args.alarm_kafka, args.alarm_topic)

    def config():
        if args.jdbc_url:
            return read_config_snapshot(spark, jdbc_url=args.jdbc_url, table=args.config,
                                        properties=_properties(args))
        return read_config_snapshot(spark, path=args.config)
    return monitor_stream(spark, _lines(spark, args), config, args.out,
                          checkpoint=args.checkpoint, trigger=_trigger(args),
                          source=_source(args), archive=not args.no_archive,
                          strict=args.strict, alarm_writer=alarm_writer)


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    spark = get_spark(args.master)
    if args.cmd == "rollup":
        run_rollup(spark, args.table, args.type, args.siteId, args.start, args.end,
                   args.output, args.label_offset_hours, args.end_stamped, args.jdbc_url,
                   _properties(args))
    elif args.cmd == "averages":
        _averages(spark, args).awaitTermination()
    elif args.cmd == "compact":
        averaged_table(spark, args.table).compact()
    elif args.cmd == "alarms":
        _alarms(spark, args).awaitTermination()
    elif args.cmd == "monitor":
        _monitor(spark, args).awaitTermination()
    elif args.cmd == "topn":
        reports = accepted_reports(annotate_reports(_lines(spark, args)))
        top = topn_stream(reports, n=args.n, size=args.size, slide=args.slide,
                          watermark=args.watermark, levels=tuple(args.site_buckets))
        file_stream(top, args.out, "topn", checkpoint=args.checkpoint, source=_source(args),
                    trigger=_trigger(args), show=args.print).awaitTermination()
    elif args.cmd == "changelog":
        changes = read_config_changes(spark, args.kafka, args.topic)
        file_stream(config_changelog(changes), args.out, "changelog", mode="complete",
                    checkpoint=args.checkpoint, source=f"kafka:{args.kafka}/{args.topic}",
                    show=args.print).awaitTermination()
    elif args.cmd == "purge":
        purge_table(spark, args.table, "type", args.types)
    return 0


if __name__ == "__main__":
    sys.exit(main())
