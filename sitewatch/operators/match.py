"""Threshold matching of reports against per-site configurations.

JN-1  latest-config lookup: left equi-join on site, config side broadcast
      after a check of its bytes (one row per site), no shuffle of the reports.
JN-2  config state update: the last arrival per site wins, whatever its version
      or timestamp.
JN-3  threshold test per open rule: violation iff max < v OR min > v.
JN-4  split output: every report once with status 1 when any rule broke,
      plus one alarm per violated rule.
JN-5  single-slot variant: one config (the last received) for one site.

The rule test is a higher-order ``filter`` over the rule map inside one
projection: narrow, codegen'd, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatch import schemas as S
from sitewatch.functions.json import parse_rules, readings_map
from sitewatch.operators.broadcast import checked_broadcast
from sitewatch.operators.latest import latest_per_key

# The order in which configs arrived: a number that grows with every change.
ARRIVAL = ("config_id",)
CFG_COLS = ("config_id", "is_delete", "interval", "rules")


def prepare_config(configs: DataFrame, key: str = "site_id",
                   order=ARRIVAL) -> DataFrame:
    """Config rows -> one active row per site: site_id, config_id, is_delete,
    interval, rules (parsed map). Accepts ``monitor_items`` as JSON text or
    as an already parsed map. ``order`` is the order of arrival."""
    latest = latest_per_key(configs, key, order)
    items = latest["monitor_items"]
    rules = parse_rules(items) if dict(latest.dtypes)["monitor_items"] == "string" else items
    return latest.select(F.col(key).alias("site_id"), F.col("config_id"),
                         F.col("is_delete"), F.col("interval"), rules.alias("rules"))


def _with_data(df: DataFrame, data: str) -> DataFrame:
    """Make sure the readings map exists (built from sensor columns if not)."""
    return df if data in df.columns else df.withColumn(data, readings_map())


def violations(rules: str, data: str, is_delete: str | None = None,
               interval: str | None = None, honour_switches: bool = True) -> Column:
    """Array of ``struct(sensor, reading, rule)`` for every broken rule.

    Site skipped when ``is_delete == 1`` or ``interval <= 0`` (NULL reads as 0,
    like the JDBC getter); rules with ``open <= 0`` skipped; a missing, NULL or
    NaN reading is normal; equality is normal. Each reading is looked up once
    per rule. One SQL expression (higher-order functions), parsed once.
    """
    checks = ["h.reading IS NOT NULL", "NOT isnan(h.reading)",
              "(h.rule.max < h.reading OR h.rule.min > h.reading)"]
    if honour_switches:
        checks = [f"coalesce(`{is_delete}`, 0) != 1", f"coalesce(`{interval}`, 0) > 0",
                  "coalesce(h.rule.open, 0) > 0"] + checks
    empty = f"CAST(map() AS {S.RULES.simpleString()})"
    return F.expr(f"""
      filter(
        transform(map_entries(coalesce(`{rules}`, {empty})),
                  e -> named_struct('sensor', e.key,
                                    'reading', try_element_at(`{data}`, e.key),
                                    'rule', e.value)),
        h -> coalesce({' AND '.join(checks)}, false))""")


def apply_rules(df: DataFrame, data: str = "data", rules: str = "rules",
                is_delete: str = "is_delete", interval: str = "interval",
                status: str = "status") -> DataFrame:
    """JN-3 + JN-4 main output on rows that already carry their config."""
    df = _with_data(df, data)
    return (df.withColumn("violations", violations(rules, data, is_delete, interval))
              .withColumn(status, F.expr(f"CASE WHEN size(violations) > 0 THEN 1 "
                                         f"ELSE `{status}` END")))


def _salted_left_join(left: DataFrame, right: DataFrame, key: str,
                      buckets: int) -> DataFrame:
    """Left join on ``key`` that splits every key over ``buckets`` tasks.

    Left rows get a deterministic salt (a hash of their atomic columns, so a
    retried task recomputes the same salt); right rows are replicated once
    per salt. A hot key's left rows thus land in up to ``buckets`` shuffle
    partitions instead of one.
    """
    atomic = [F.col(c) for c, t in left.dtypes
              if not t.startswith(("map", "array", "struct"))]
    salt = F.pmod(F.xxhash64(*atomic), F.lit(buckets)).cast("int")
    salted = left.withColumn("_salt", salt)
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted.join(copies, on=[key, "_salt"], how="left").drop("_salt")


def match_reports(reports: DataFrame, configs: DataFrame, key: str = "site_id",
                  order=ARRIVAL, max_broadcast_bytes: int | None = None,
                  salt_buckets: int = 16, config_bytes: int | None = None) -> DataFrame:
    """JN-1 + JN-3 + JN-4: annotate each report with its violations.

    ``configs`` are config rows (any history); the last to arrive per site is used.
    Reports of sites without a config pass through unmatched.
    Output: report columns (status updated) + config_id + violations.

    The one-row-per-site config is broadcast when its bytes are proven within
    ``max_broadcast_bytes``; beyond that the join is salted over
    ``salt_buckets`` so a hot site does not end up in one task.
    ``config_bytes``: a known bound on the config's bytes (skips measuring).
    """
    cfg = prepare_config(configs, key, order)
    kw = {} if max_broadcast_bytes is None else {"max_bytes": max_broadcast_bytes}
    shipped = checked_broadcast(cfg, known_bytes=config_bytes, **kw)
    cfg_cols = ([F.col("site_id").alias(key)]
                + [F.col(c).alias(f"_cfg_{c}") for c in CFG_COLS])
    if shipped is cfg and not cfg.isStreaming:
        joined = _salted_left_join(reports, cfg.select(cfg_cols), key, salt_buckets)
    else:
        joined = reports.join(shipped.select(cfg_cols), on=key, how="left")
    out = apply_rules(joined, rules="_cfg_rules", is_delete="_cfg_is_delete",
                      interval="_cfg_interval")
    return out.withColumnRenamed("_cfg_config_id", "config_id").drop(
        "_cfg_rules", "_cfg_is_delete", "_cfg_interval")


def alarms(matched: DataFrame) -> DataFrame:
    """JN-4 side output: one row per violated rule (report copy has status 1).

    Adds ``sensor, reading, rule`` and drops ``violations``.
    """
    # explode_outer + filter on the generated column: a plain explode makes
    # Catalyst infer size(violations) > 0 below the projection, which would
    # evaluate the rule test twice per report.
    keep = [f"`{c}`" for c in matched.columns if c != "violations"]
    return (matched.selectExpr(*keep, "explode_outer(violations) AS _v")
                   .where("_v IS NOT NULL")
                   .selectExpr(*keep, "_v.sensor AS sensor", "_v.reading AS reading",
                               "_v.rule AS rule"))


def single_slot_match(reports: DataFrame, configs: DataFrame,
                      order: str = "config_id", key: str = "site_id") -> DataFrame:
    """JN-5: keep only the last received config (for whatever site) and emit
    (report, rule) pairs of that site whose reading breaks the rule; the open
    flag, delete flag and interval are not consulted."""
    last = configs.orderBy(F.col(order).desc()).limit(1)
    items = last["monitor_items"]
    rules = parse_rules(items) if dict(last.dtypes)["monitor_items"] == "string" else items
    last = checked_broadcast(last.select(F.col(key), rules.alias("_rules")))
    joined = _with_data(reports.join(last, on=key, how="inner"), "data")
    out = (joined.withColumn("violations", violations("_rules", "data",
                                                      honour_switches=False))
                 .withColumn("status", F.expr("CASE WHEN size(violations) > 0 THEN 1 "
                                              "ELSE status END"))
                 .drop("_rules"))
    return alarms(out)

