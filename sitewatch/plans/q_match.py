"""Queries over threshold matching (JN-1..JN-5, PRJ-8, SNK-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewatch import fixtures as FX
from sitewatch.functions.json import parse_rules, report_struct, rule_struct, to_json_text
from sitewatch.operators.asof import asof_join
from sitewatch.operators.match import (alarms, apply_rules, match_reports,
                                       single_slot_match)
from sitewatch.operators.windows import as_ntz
from sitewatch.plans import oracle as O
from sitewatch.plans.catalog import register


def _matched(spark, sf_dir):
    return match_reports(FX.reports_with_data(spark, sf_dir), FX.site_configs(spark),
                         config_bytes=FX.SITE_RULES_BYTES)


def _alarm_cols(df):
    return df.select("report_id", "site_id", as_ntz("ts").alias("ts"), "timestamp",
                     "status", "sensor", "reading",
                     F.col("rule.type").alias("rule_type"),
                     F.col("rule.open").alias("rule_open"),
                     F.col("rule.max").alias("rule_max"),
                     F.col("rule.min").alias("rule_min"))


_READING = "CASE s.sensor WHEN 'tmp' THEN r.tmp WHEN 'hmt' THEN r.hmt WHEN 'lx' THEN r.lx END"

ALARMS_SQL = f"""WITH {O.REPORTS}, {O.site_rules_values()},
pairs AS (
  SELECT r.report_id, r.site_id, r.ts, r."timestamp", r.type, r.version,
         r.tmp, r.hmt, r.lx, s.sensor, {_READING} AS reading,
         s.is_delete, s."interval", s.open, s.max, s.min
  FROM reports r JOIN site_rules s ON r.site_id = s.site_id),
hits AS (
  SELECT * FROM pairs
  WHERE is_delete <> 1 AND "interval" > 0 AND open > 0 AND reading IS NOT NULL
    AND NOT isnan(reading) AND (max < reading OR min > reading))"""


@register("alarms", ALARMS_SQL + """
SELECT report_id, site_id, ts, "timestamp", 1 AS status, sensor, reading,
       sensor AS rule_type, open AS rule_open, max AS rule_max, min AS rule_min
FROM hits""")
def q_alarms(spark, sf_dir):
    """JN-1 + JN-3 + JN-4 side output: one row per violated rule."""
    return _alarm_cols(alarms(_matched(spark, sf_dir)))


@register("report_status", ALARMS_SQL + """,
n AS (SELECT report_id, COUNT(*) AS n_alarms FROM hits GROUP BY report_id)
SELECT r.report_id, r.site_id, r.ts, r."timestamp", r.type, r.version,
       CASE WHEN n.n_alarms > 0 THEN 1 ELSE r.status END AS status,
       r.tmp, r.hmt, r.lx, COALESCE(n.n_alarms, 0) AS n_alarms
FROM reports r LEFT JOIN n ON r.report_id = n.report_id""")
def q_report_status(spark, sf_dir):
    """JN-4 main output: every report once, status 1 when any rule broke."""
    m = _matched(spark, sf_dir)
    return m.select("report_id", "site_id", as_ntz("ts").alias("ts"), "timestamp",
                    "type", "version", "status", "tmp", "hmt", "lx",
                    F.size("violations").cast("long").alias("n_alarms"))


@register("alarm_json", ALARMS_SQL + """
SELECT report_id, sensor,
       to_json({'dataReport': {'siteId': site_id, 'timestamp': "timestamp", 'type': type,
                               'version': version, 'status': 1,
                               'data': MAP {'tmp': tmp, 'hmt': hmt, 'lx': lx}},
                'monitorItem': {'type': sensor, 'open': open, 'max': max, 'min': min}})::VARCHAR
         AS value
FROM hits""")
def q_alarm_json(spark, sf_dir):
    """PRJ-8 + SNK-1: alarms serialized as the wire JSON sent to the alarm topic."""
    a = alarms(_matched(spark, sf_dir))
    payload = F.struct(report_struct().alias("dataReport"),
                       rule_struct("rule.type", "rule.open", "rule.max",
                                   "rule.min").alias("monitorItem"))
    return a.select("report_id", "sensor", to_json_text(payload).alias("value"))


@register("single_slot_match", f"""WITH {O.REPORTS}, {O.site_rules_values()},
last_cfg AS (SELECT * FROM site_rules
             WHERE config_id = (SELECT max(config_id) FROM site_rules)),
pairs AS (
  SELECT r.report_id, r.site_id, r.ts, r."timestamp", s.sensor, {_READING} AS reading,
         s.open, s.max, s.min
  FROM reports r JOIN last_cfg s ON r.site_id = s.site_id)
SELECT report_id, site_id, ts, "timestamp", 1 AS status, sensor, reading,
       sensor AS rule_type, open AS rule_open, max AS rule_max, min AS rule_min
FROM pairs
WHERE reading IS NOT NULL AND NOT isnan(reading) AND (max < reading OR min > reading)""")
def q_single_slot(spark, sf_dir):
    """JN-5: only the last received config is kept; open/delete/interval ignored."""
    return _alarm_cols(single_slot_match(FX.reports_with_data(spark, sf_dir),
                                         FX.site_configs(spark)))


def _asof_check(sensor):
    return (f"CASE WHEN {sensor}_open > 0 AND {sensor} IS NOT NULL AND NOT isnan({sensor}) "
            f"AND ({sensor}_max < {sensor} OR {sensor}_min > {sensor}) THEN 1 ELSE 0 END")


@register("config_asof_match", f"""WITH {O.REPORTS}, {O.CONFIG_CHANGES},
c AS (SELECT * FROM config_changes
      QUALIFY row_number() OVER (PARTITION BY site_id, ts ORDER BY config_id DESC) = 1),
m AS (
  SELECT r.report_id, r.site_id, r.ts, r.status, r.tmp, r.hmt, r.lx,
         c.config_id, c.is_delete, c."interval",
         c.tmp_open, c.tmp_max, c.tmp_min, c.hmt_open, c.hmt_max, c.hmt_min,
         c.lx_open, c.lx_max, c.lx_min
  FROM reports r ASOF LEFT JOIN c
    ON r.site_id = c.site_id AND r.ts >= c.ts),
n AS (
  SELECT *, CAST(CASE WHEN config_id IS NULL OR is_delete = 1 OR "interval" <= 0 THEN 0
                 ELSE {_asof_check('tmp')} + {_asof_check('hmt')} + {_asof_check('lx')}
                 END AS BIGINT) AS n_alarms
  FROM m)
SELECT report_id, site_id, ts, config_id,
       CASE WHEN n_alarms > 0 THEN 1 ELSE status END AS status, n_alarms
FROM n""")
def q_config_asof(spark, sf_dir):
    """JN-1 batch form: each report is matched against the config of its site
    that was in force at the report's event time (as-of join)."""
    # project before the as-of join: its shuffle carries whole left rows, and of a change the
    # text of its rules
    reports = FX.reports_with_data(spark, sf_dir).select(
        "report_id", "site_id", "ts", "status", "data")
    joined = asof_join(reports, FX.config_changes(spark, sf_dir), key="site_id", left_ts="ts",
                       right_ts="ts", right_order="config_id",
                       right_cols=["config_id", "is_delete", "interval", "monitor_items"],
                       prefix="cfg_").withColumn("cfg_rules", parse_rules("cfg_monitor_items"))
    m = apply_rules(joined, rules="cfg_rules", is_delete="cfg_is_delete",
                    interval="cfg_interval")
    return m.select("report_id", "site_id", as_ntz("ts").alias("ts"),
                    F.col("cfg_config_id").alias("config_id"), "status",
                    F.size("violations").cast("long").alias("n_alarms"))
