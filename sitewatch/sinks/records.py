"""Shape DataFrames into the records each sink writes (pure projections).

SNK-1 alarm JSON, SNK-3/4 table rows, SNK-5/6 archive lines, SNK-8 search
documents, SNK-10 text rendering. The writers in ``sinks.writers`` only move
these rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatch import schemas as S
from sitewatch.functions.json import report_struct, rule_struct, to_json_text


def alarm_records(alarms: DataFrame, keep=()) -> DataFrame:
    """SNK-1: ``value`` = ``{"dataReport": {...}, "monitorItem": {...}}``."""
    payload = F.struct(report_struct().alias("dataReport"),
                       rule_struct("rule.type", "rule.open", "rule.max",
                                   "rule.min").alias("monitorItem"))
    return alarms.select(*keep, to_json_text(payload).alias("value"))


def report_rows(reports: DataFrame, keep=()) -> DataFrame:
    """SNK-3: table row of a report, the readings map stored as JSON text."""
    return reports.select(*keep, "site_id", "timestamp", "type", "version", "status",
                          to_json_text("data").alias("data"))


def archive_records(reports: DataFrame, bucket_time: str = "processing",
                    ts: str = "ts", keep=()) -> DataFrame:
    """SNK-5/6: one JSON line per report plus its ``day`` folder (yyyy-MM-dd).

    ``bucket_time='processing'`` buckets by the wall clock at write time, as
    the reference's date bucket assigner does; ``'event'`` by report time.
    """
    when = F.current_timestamp() if bucket_time == "processing" else F.col(ts)
    return reports.select(*keep, F.date_format(when, S.ARCHIVE_DAY_FORMAT).alias("day"),
                          to_json_text(report_struct()).alias("value"))


def search_documents(clicks: DataFrame, key: str = "user",
                     value: str = "timestamp", keep=()) -> DataFrame:
    """SNK-8: one document ``{<user>: <timestamp>}`` per click."""
    return clicks.select(*keep,
                         F.to_json(F.create_map(F.col(key), F.col(value))).alias("doc"))


# The one-line renderings of the four printed records.
EVENT_TEXT = "Event{user='%s', usr='%s', timestamp=%s}"
COUNT_TEXT = "ReportCountView{siteId='%s', count=%s, start=%s, end=%s}"
REPORT_TEXT = ("DataReportTableRow{siteId=%s, timestamp=%s, type='%s', version=%s, "
               "status=%s, tmp=%s, hmt=%s, lx=%s}")
RULE_TEXT = "MonitorItem{type='%s', open=%s, max=%s, min=%s}"


def instant_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f``: as many decimals of the second as there are, one
    at least."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"), "0{1,2}$", "")


def number_text(c: str) -> Column:
    """A reading as text, ``null`` without one."""
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def event_text(clicks: DataFrame, keep=()) -> DataFrame:
    """PRJ-12: readable one-line rendering of a click."""
    return clicks.select(*keep, F.format_string(
        EVENT_TEXT, F.col("user"), F.col("url"),
        instant_text(F.timestamp_millis("timestamp"))).alias("value"))


def count_view_text(counts: DataFrame, key: str = "site_id") -> DataFrame:
    """PRJ-12: readable rendering of a windowed count."""
    return counts.select(F.format_string(
        COUNT_TEXT, F.col(key), F.col("cnt"), instant_text("window_start"),
        instant_text("window_end")).alias("value"))


def report_text(reports: DataFrame, keep=()) -> DataFrame:
    """PRJ-12: readable rendering of a flattened report."""
    return reports.select(*keep, F.format_string(
        REPORT_TEXT, F.col("site_id"), instant_text(F.timestamp_millis("timestamp")),
        F.col("type"), F.col("version"), F.col("status"),
        *[number_text(s) for s in S.SENSORS]).alias("value"))


def rule_text(rules: DataFrame, keep=()) -> DataFrame:
    """PRJ-12: readable rendering of a threshold rule (columns of ``explode_rules``)."""
    return rules.select(*keep, F.format_string(
        RULE_TEXT, F.col("rule_type"), F.col("open"), number_text("max"),
        number_text("min")).alias("value"))


def name_url_rows(clicks: DataFrame, keep=()) -> DataFrame:
    """SNK-4: the (name, url) row of a click."""
    return clicks.select(*keep, F.col("user").alias("name"), "url")
