"""JSON codecs for reports, rules, configs and alarms (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewatch import schemas as S

# Jackson writes NULL fields; Spark drops them unless told otherwise.
JSON_WRITE_OPTS = {"ignoreNullFields": "false"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def readings_map(*sensors: str) -> Column:
    """``map('tmp', tmp, 'hmt', hmt, 'lx', lx)`` from flattened columns."""
    sensors = sensors or S.SENSORS
    return F.expr("map(" + ", ".join(f"'{s}', CAST(`{s}` AS DOUBLE)" for s in sensors) + ")")


def _q(name: str) -> str:
    """SQL reference to a column or nested field: ``rule.max`` -> `rule`.`max`."""
    return ".".join(f"`{part}`" for part in name.split("."))


def report_struct(site_id="site_id", timestamp="timestamp", type_="type",
                  version="version", status="status", data="data") -> Column:
    """Wire-shaped report struct (camelCase names) from table columns."""
    return F.expr(f"named_struct('siteId', CAST({_q(site_id)} AS INT), "
                  f"'timestamp', CAST({_q(timestamp)} AS BIGINT), 'type', {_q(type_)}, "
                  f"'version', CAST({_q(version)} AS INT), "
                  f"'status', CAST({_q(status)} AS INT), 'data', {_q(data)})")


def rule_struct(type_, open_, max_, min_) -> Column:
    """Wire-shaped rule struct from columns or nested fields."""
    return F.expr(f"named_struct('type', {_q(type_)}, 'open', CAST({_q(open_)} AS INT), "
                  f"'max', CAST({_q(max_)} AS DOUBLE), 'min', CAST({_q(min_)} AS DOUBLE))")


def to_json_text(c) -> Column:
    """Serialize any struct/map column to compact JSON, nulls kept."""
    return F.to_json(_col(c), JSON_WRITE_OPTS)


def parse_rules(c) -> Column:
    """``monitor_items`` JSON text -> ``MAP<STRING, STRUCT<type,open,max,min>>``.

    Unparseable text gives NULL, which the matcher treats as "no rules".
    """
    return F.from_json(_col(c), S.RULES)


def parse_alarm(c) -> Column:
    return F.from_json(_col(c), S.ALARM_WIRE)


def parse_config_message(c) -> Column:
    return F.from_json(_col(c), S.CONFIG_WIRE)
