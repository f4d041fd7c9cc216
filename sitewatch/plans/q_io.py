"""Queries over parsing, projections and sink records
(PRJ-1..PRJ-10, SRC-7/8, SNK-5/8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewatch import fixtures as FX
from sitewatch.operators.parse import (accepted_reports, annotate_config_messages,
                                       annotate_csv_events, annotate_reports,
                                       explode_rules, parse_config_messages,
                                       parse_csv_events, parse_report_table,
                                       rejected_lines, rejected_reports)
from sitewatch.operators.windows import as_ntz, window_averages, window_counts
from sitewatch.plans import oracle as O
from sitewatch.plans.catalog import register
from sitewatch.functions.json import parse_alarm
from sitewatch.operators.match import alarms, match_reports
from sitewatch.plans.q_match import ALARMS_SQL
from sitewatch.sinks.records import (alarm_records, archive_records, count_view_text,
                                     event_text, name_url_rows, report_rows, report_text,
                                     rule_text, search_documents)
from sitewatch.sources.readers import read_tier


# The accepted forms of malformed and edge lines (the first and the last) as rows.
_ACCEPTED_EDGE = """SELECT site_id, "timestamp", make_timestamp("timestamp" * 1000) AS ts,
  'report' AS type, 1 AS version, 0 AS status,
  CASE WHEN form = 0 THEN CAST(20.5 AS DOUBLE) END AS tmp,
  CASE WHEN form = 0 THEN CAST(0.5 AS DOUBLE) END AS hmt,
  CASE WHEN form = 0 THEN CAST(100.0 AS DOUBLE) END AS lx
FROM bad_lines WHERE form IN (0, 11)"""


@register("parse_reports", f"""WITH {O.REPORTS}, {O.bad_lines(FX.BAD_REPORT_FORMS)}
SELECT site_id, "timestamp", make_timestamp("timestamp" * 1000) AS ts, type, version, status,
       tmp, hmt, lx FROM reports
UNION ALL {_ACCEPTED_EDGE}""")
def q_parse_reports(spark, sf_dir):
    """PRJ-1/2/3/4: JSON report text -> typed, flattened reports with their event
    time (bad ones out)."""
    good = accepted_reports(annotate_reports(FX.reports_json(spark, sf_dir)))
    return good.select("site_id", "timestamp", as_ntz("ts").alias("ts"), "type", "version",
                       "status", "tmp", "hmt", "lx")


@register("quarantine", f"WITH {O.bad_lines(FX.BAD_REPORT_FORMS)}\n"
          + O.rejected(FX.BAD_REPORT_FORMS))
def q_quarantine(spark, sf_dir):
    """PRJ-2 / D1-D2: the report lines set aside, with the reason."""
    return rejected_reports(annotate_reports(FX.reports_json(spark, sf_dir)))


@register("csv_rejects", f"WITH {O.bad_lines(FX.BAD_CSV_FORMS)}\n"
          + O.rejected(FX.BAD_CSV_FORMS, "event_id, "))
def q_csv_rejects(spark, sf_dir):
    """SRC-8: the click lines set aside, with the reason."""
    return rejected_lines(annotate_csv_events(FX.csv_lines(spark, sf_dir)), keep=("event_id",))


@register("config_rejects", f"WITH {O.bad_lines(FX.BAD_CONFIG_FORMS)}\n"
          + O.rejected(FX.BAD_CONFIG_FORMS, "-1 - event_id AS config_id, "))
def q_config_rejects(spark, sf_dir):
    """SRC-4: the config messages set aside, with the reason."""
    return rejected_lines(annotate_config_messages(FX.config_messages(spark, sf_dir)),
                          keep=("config_id",))


def _rules_sql(sensor):
    return (f"SELECT config_id, site_id, '{sensor}' AS sensor, '{sensor}' AS rule_type, "
            f"{sensor}_open AS open, {sensor}_max AS max, {sensor}_min AS min "
            f"FROM config_changes")


@register("config_rules", f"""WITH {O.CONFIG_CHANGES}
{_rules_sql('tmp')} UNION ALL {_rules_sql('hmt')} UNION ALL {_rules_sql('lx')}""")
def q_config_rules(spark, sf_dir):
    """PRJ-10: config rows with JSON rule text -> one row per (config, rule)."""
    return explode_rules(FX.config_changes(spark, sf_dir))


@register("csv_events", f"""WITH {O.CLICKS}
SELECT "user", url, "timestamp" FROM clicks""")
def q_csv_events(spark, sf_dir):
    """SRC-8: comma-separated click lines -> (user, url, timestamp)."""
    return parse_csv_events(FX.csv_lines(spark, sf_dir))


@register("select_le3", f"""WITH {O.REPORTS}
SELECT site_id, "timestamp", type, version FROM reports WHERE site_id <= 3""")
def q_select_le3(spark, sf_dir):
    """PRJ-5/6: column selection and the range predicate site <= 3 (SQL form)."""
    FX.reports(spark, sf_dir).createOrReplaceTempView("sitewatch_reports")
    return spark.sql("SELECT site_id, timestamp, type, version "
                     "FROM sitewatch_reports WHERE site_id <= 3")


@register("search_documents", f"""WITH {O.CLICKS}
SELECT event_id, json_object("user", "timestamp")::VARCHAR AS doc FROM clicks""")
def q_search_documents(spark, sf_dir):
    """SNK-8: one search document {user: timestamp} per click."""
    return search_documents(FX.clicks(spark, sf_dir), keep=("event_id",))


@register("archive_lines", f"""WITH {O.REPORTS}
SELECT report_id, strftime(ts, '%Y-%m-%d') AS day,
       to_json({{'siteId': site_id, 'timestamp': "timestamp", 'type': type,
                'version': version, 'status': status,
                'data': MAP {{'tmp': tmp, 'hmt': hmt, 'lx': lx}}}})::VARCHAR AS value
FROM reports""")
def q_archive_lines(spark, sf_dir):
    """SNK-5: archive line per report with its day folder (event-time day)."""
    return archive_records(FX.reports_with_data(spark, sf_dir), bucket_time="event",
                           keep=("report_id",))


@register("report_rows", f"""WITH {O.REPORTS}
SELECT report_id, site_id, "timestamp", type, version, status,
       to_json(MAP {{'tmp': tmp, 'hmt': hmt, 'lx': lx}})::VARCHAR AS data
FROM reports""")
def q_report_rows(spark, sf_dir):
    """SNK-3: report table rows with the readings map stored as JSON text."""
    return report_rows(FX.reports_with_data(spark, sf_dir), keep=("report_id",))


def _instant_sql(ts):
    """Seconds with as many decimals as there are, one at least."""
    return f"regexp_replace(strftime({ts}, '%Y-%m-%d %H:%M:%S.%g'), '0{{1,2}}$', '')"


def _or_null(column):
    return f"coalesce(CAST({column} AS VARCHAR), 'null')"


@register("click_text", f"""WITH {O.CLICKS}
SELECT event_id, 'Event{{user=''' || "user" || ''', usr=''' || url || ''', timestamp='
  || {_instant_sql('make_timestamp("timestamp" * 1000)')} || '}}' AS value
FROM clicks""")
def q_click_text(spark, sf_dir):
    """PRJ-12: readable one-line rendering of every click."""
    return event_text(FX.clicks(spark, sf_dir), keep=("event_id",))


@register("count_text", f"""WITH {O.REPORTS},
c AS (SELECT site_id, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS t,
             COUNT(*) AS cnt FROM reports GROUP BY ALL)
SELECT 'ReportCountView{{siteId=''' || site_id || ''', count=' || cnt || ', start='
  || {_instant_sql('t')} || ', end=' || {_instant_sql("t + INTERVAL '1 hour'")} || '}}' AS value
FROM c""")
def q_count_text(spark, sf_dir):
    """PRJ-12: readable rendering of every site's hourly count."""
    return count_view_text(window_counts(FX.reports(spark, sf_dir), "site_id", "1 hour"))


@register("report_text", f"""WITH {O.REPORTS}
SELECT report_id, 'DataReportTableRow{{siteId=' || site_id || ', timestamp='
  || {_instant_sql('make_timestamp("timestamp" * 1000)')} || ', type=''' || type
  || ''', version=' || version || ', status=' || status || ', tmp=' || {_or_null('tmp')}
  || ', hmt=' || {_or_null('hmt')} || ', lx=' || {_or_null('lx')} || '}}' AS value
FROM reports""")
def q_report_text(spark, sf_dir):
    """PRJ-12: readable one-line rendering of every report."""
    return report_text(FX.reports(spark, sf_dir), keep=("report_id",))


@register("rule_text", f"""WITH {O.CONFIG_CHANGES},
rules AS ({_rules_sql('tmp')} UNION ALL {_rules_sql('hmt')} UNION ALL {_rules_sql('lx')})
SELECT config_id, 'MonitorItem{{type=''' || rule_type || ''', open=' || open || ', max='
  || {_or_null('max')} || ', min=' || {_or_null('min')} || '}}' AS value
FROM rules""")
def q_rule_text(spark, sf_dir):
    """PRJ-12: readable rendering of every threshold rule."""
    return rule_text(explode_rules(FX.config_changes(spark, sf_dir)), keep=("config_id",))


@register("name_url_rows", f"""WITH {O.CLICKS}
SELECT event_id, "user" AS name, url FROM clicks""")
def q_name_url(spark, sf_dir):
    """SNK-4: the (name, url) row of every click."""
    return name_url_rows(FX.clicks(spark, sf_dir), keep=("event_id",))


@register("tier_scan", f"""WITH {O.REPORTS},
{O.tier_cte('t2', 2)}
SELECT * FROM t2 WHERE site_id = 3
  AND end_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'""")
def q_tier_scan(spark, sf_dir):
    """SRC-3 / PRJ-11: one site's HOUR averages in an inclusive time range."""
    table = window_averages(FX.reports(spark, sf_dir), tier=2)
    out = read_tier(table, site_id=3, start="2024-01-05 00:00:00", end="2024-01-12 00:00:00",
                    tier_code=2)
    return out.select("site_id", as_ntz("end_time").alias("end_time"), "type",
                      "avg_tmp", "avg_hmt", "avg_lx")


@register("alarm_roundtrip", ALARMS_SQL + """
SELECT report_id, site_id, "timestamp", 1 AS status, tmp, hmt, lx,
       sensor AS rule_type, open AS rule_open, max AS rule_max, min AS rule_min
FROM hits""")
def q_alarm_roundtrip(spark, sf_dir):
    """PRJ-9: alarm JSON text parsed back into the nested record."""
    a = alarms(match_reports(FX.reports_with_data(spark, sf_dir), FX.site_configs(spark),
                             config_bytes=FX.SITE_RULES_BYTES))
    text = alarm_records(a, keep=("report_id",))
    back = text.select("report_id", parse_alarm("value").alias("a"))
    d = F.col("a.dataReport")
    return back.select("report_id", d["siteId"].alias("site_id"),
                       d["timestamp"].alias("timestamp"), d["status"].alias("status"),
                       d["data"]["tmp"].alias("tmp"), d["data"]["hmt"].alias("hmt"),
                       d["data"]["lx"].alias("lx"),
                       F.col("a.monitorItem.type").alias("rule_type"),
                       F.col("a.monitorItem.open").alias("rule_open"),
                       F.col("a.monitorItem.max").alias("rule_max"),
                       F.col("a.monitorItem.min").alias("rule_min"))


@register("report_table", f"""WITH {O.REPORTS}
SELECT site_id AS "siteId", "timestamp", type, version, status,
       to_json(MAP {{'tmp': tmp, 'hmt': hmt, 'lx': lx}})::VARCHAR AS data
FROM reports""")
def q_report_table(spark, sf_dir):
    """SRC-7 / PRJ-7: declared JSON table over the report text, tolerant of
    missing fields, with ``data`` kept as raw JSON text."""
    return parse_report_table(FX.reports_wire(spark, sf_dir))


def _msg_rules_sql(sensor):
    return (f"SELECT config_id, site_id, \"interval\", is_delete, '{sensor}' AS sensor, "
            f"'{sensor}' AS rule_type, {sensor}_open AS open, {sensor}_max AS max, "
            f"{sensor}_min AS min FROM config_changes")


@register("config_messages", f"""WITH {O.CONFIG_CHANGES}
{_msg_rules_sql('tmp')} UNION ALL {_msg_rules_sql('hmt')} UNION ALL {_msg_rules_sql('lx')}""")
def q_config_messages(spark, sf_dir):
    """SRC-4 / PRJ-10: config change messages (wire JSON) parsed into rules."""
    cfg = parse_config_messages(FX.config_messages(spark, sf_dir), keep=("config_id",))
    return explode_rules(cfg, keep=("config_id", "site_id", "interval", "is_delete"))
