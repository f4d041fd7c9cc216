"""Parsing of incoming text with a quarantine split (PRJ-1/2/3/4, PRJ-9/10,
SRC-4, SRC-7, SRC-8).

Everything is one projection over the input (``from_json`` / ``split``):
no shuffle, and the same function serves a batch table and a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewatch import schemas as S

CORRUPT = "_corrupt"
REJECT_MALFORMED = "malformed"
REJECT_MISSING_KEY = "missing_site_or_time"
REJECT_UNKNOWN_FIELD = "unknown_field"
REJECT_FIELDS = "too_few_fields"
REJECT_TIME = "bad_timestamp"
REJECT_MISSING_SITE = "missing_site"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def annotate_reports(lines: DataFrame, value: str = "value", strict: bool = False,
                     schema: T.StructType = S.REPORT_WIRE) -> DataFrame:
    """Parse ``value`` into ``report`` (wire struct) and set ``reject_reason``.

    Rejected: text that is not a JSON object of the right types (including a
    bare NaN or a quoted/fractional id), and reports without siteId or
    timestamp. ``strict`` also rejects unknown top-level fields (the
    reference's mapper does; by default they are ignored).
    """
    parsed = F.from_json(F.col(value), _with_corrupt(schema),
                         {"columnNameOfCorruptRecord": CORRUPT,
                          "allowNonNumericNumbers": "false"})
    # The parse goes through a one-row generator: later filters on the parsed
    # fields cannot be pushed below it, so each line is parsed exactly once
    # (a plain projection would be inlined into every field reference).
    df = lines.select("*", F.inline(F.array(F.struct(parsed.alias("report")))))
    r = F.col("report")
    reason = (F.when(r.isNull() | r[CORRUPT].isNotNull(), F.lit(REJECT_MALFORMED))
               .when(r["siteId"].isNull() | r["timestamp"].isNull(),
                     F.lit(REJECT_MISSING_KEY)))
    if strict:
        known = F.array(*[F.lit(f.name) for f in schema.fields])
        unknown = F.size(F.array_except(F.json_object_keys(F.col(value)), known)) > 0
        reason = reason.when(unknown, F.lit(REJECT_UNKNOWN_FIELD))
    return df.withColumn("reject_reason", reason)


def accepted_reports(annotated: DataFrame, sensors=S.SENSORS, keep=()) -> DataFrame:
    """PRJ-2/3/4: accepted rows as table columns: site_id, timestamp, ts
    (event time), type, version, status, data, and one column per sensor, after the
    ``keep`` columns."""
    r = F.col("report")
    out = annotated.where(F.col("reject_reason").isNull()).select(
        *keep, r["siteId"].alias("site_id"), r["timestamp"].alias("timestamp"),
        F.timestamp_millis(r["timestamp"]).alias("ts"),
        r["type"].alias("type"), r["version"].alias("version"),
        r["status"].alias("status"), r["data"].alias("data"))
    return flatten_readings(out, sensors)


def rejected_reports(annotated: DataFrame, value: str = "value") -> DataFrame:
    """Quarantine: the raw text and why it was set aside."""
    return rejected_lines(annotated, value)


def flatten_readings(df: DataFrame, sensors=S.SENSORS, data: str = "data") -> DataFrame:
    """PRJ-3: ``data['tmp']`` etc. as columns; a missing key gives NULL."""
    return df.select("*", *[F.try_element_at(F.col(data), F.lit(s)).alias(s)
                            for s in sensors])


def parse_report_table(lines: DataFrame, value: str = "value") -> DataFrame:
    """SRC-7: declared JSON table, tolerant of missing fields; ``data`` kept
    as raw JSON text."""
    r = F.from_json(F.col(value), S.REPORT_WIRE_RAW_DATA)
    return lines.select(r.alias("r")).select("r.*")


def annotate_csv_events(lines: DataFrame, value: str = "value") -> DataFrame:
    """SRC-8: ``user,url,timestamp`` text as trimmed fields with a ``reject_reason``
    (fewer than 3 fields, or a timestamp that is not a number)."""
    parts = F.split(F.col(value), ",")
    fields = F.struct(F.trim(F.get(parts, 0)).alias("user"), F.trim(F.get(parts, 1)).alias("url"),
                      F.trim(F.get(parts, 2)).alias("time"),
                      F.trim(F.get(parts, 2)).try_cast("bigint").alias("timestamp"))
    df = lines.select("*", F.inline(F.array(F.struct(fields.alias("event")))))
    return df.withColumn("reject_reason", F.when(
        F.col("event.time").isNull(), F.lit(REJECT_FIELDS)).when(
        F.col("event.timestamp").isNull(), F.lit(REJECT_TIME)))


def parse_csv_events(lines: DataFrame, value: str = "value") -> DataFrame:
    """SRC-8: the accepted lines as (user, url, timestamp BIGINT)."""
    good = annotate_csv_events(lines, value).where(F.col("reject_reason").isNull())
    return good.select("event.user", "event.url", "event.timestamp")


def rejected_lines(annotated: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """Quarantine of any ``annotate_...``: the raw text and why it was set aside."""
    return annotated.where(F.col("reject_reason").isNotNull()).select(
        *keep, F.col(value), F.col("reject_reason"))


def annotate_config_messages(lines: DataFrame, value: str = "value") -> DataFrame:
    """SRC-4: the parsed message ``c`` and its ``reject_reason``."""
    c = F.from_json(F.col(value), _with_corrupt(S.CONFIG_WIRE),
                    {"columnNameOfCorruptRecord": CORRUPT})
    df = lines.select("*", F.inline(F.array(F.struct(c.alias("c")))))
    return df.withColumn("reject_reason", F.when(
        F.col("c").isNull() | F.col(f"c.{CORRUPT}").isNotNull(), F.lit(REJECT_MALFORMED)).when(
        F.col("c.siteId").isNull(), F.lit(REJECT_MISSING_SITE)))


def parse_config_messages(lines: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """SRC-4 / PRJ-10: one JSON config per message -> config rows with the
    rule map parsed (``monitor_items``); ``keep`` columns pass through."""
    parsed = annotate_config_messages(lines, value).where(F.col("reject_reason").isNull())
    return parsed.select(*keep,
        F.col("c.siteId").alias("site_id"), F.col("c.timestamp").alias("timestamp"),
        F.col("c.isDelete").alias("is_delete"), F.col("c.version").alias("version"),
        F.col("c.interval").alias("interval"), F.col("c.monitorItems").alias("monitor_items"))


def explode_rules(configs: DataFrame, items: str = "monitor_items",
                  keep=("config_id", "site_id")) -> DataFrame:
    """PRJ-10: one row per (config, sensor rule)."""
    col: Column = F.col(items)
    if dict(configs.dtypes)[items] == "string":
        col = F.from_json(col, S.RULES)
    return (configs.select(*keep, F.explode(col).alias("sensor", "rule"))
                   .select(*keep, "sensor", F.col("rule.type").alias("rule_type"),
                           F.col("rule.open").alias("open"), F.col("rule.max").alias("max"),
                           F.col("rule.min").alias("min")))
