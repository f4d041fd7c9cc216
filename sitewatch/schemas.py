"""Record schemas and fixed values of the monitoring data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for results to agree.
# Tier codes and window sizes in minutes (MONTH is a fixed 30-day block):
#   MINUTE 1 1, HOUR 2 60, DAY 3 1440, WEEK 4 10080, MONTH 5 43200
# Weekday characters, Sunday first: 日 一 二 三 四 五 六
# Comparison words: equal "dengyu", less "xiaoyu", greater "dayu"
# Elapsed-time text: "<d>天<h>小时<m>分钟"
# JSON field names of a report: siteId timestamp type version status data
# JSON field names of a rule: type open max min
# JSON field names of an alarm: dataReport monitorItem
# Archive folder format: yyyy-MM-dd
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Tier:
    code: int
    name: str
    minutes: int

    @property
    def duration(self) -> str:
        return f"{self.minutes} minutes"


TIERS = (
    Tier(1, "MINUTE", 1),
    Tier(2, "HOUR", 60),
    Tier(3, "DAY", 1440),
    Tier(4, "WEEK", 10080),
    Tier(5, "MONTH", 43200),
)
_TIER_BY_CODE = {t.code: t for t in TIERS}
_TIER_BY_NAME = {t.name: t for t in TIERS}

WEEKDAY_CN = ("日", "一", "二", "三", "四", "五", "六")
CMP_EQUAL, CMP_LESS, CMP_GREATER = "dengyu", "xiaoyu", "dayu"
ARCHIVE_DAY_FORMAT = "yyyy-MM-dd"


def tier(code_or_name) -> Tier:
    """Look a tier up by code (1..5) or name; unknown values raise.

    The reference maps unknown codes to MONTH, which silently re-averages
    MONTH into MONTH; here that is an error instead.
    """
    if isinstance(code_or_name, Tier):
        return code_or_name
    if isinstance(code_or_name, str):
        key = code_or_name.upper()
        if key in _TIER_BY_NAME:
            return _TIER_BY_NAME[key]
        raise ValueError(f"unknown tier {code_or_name!r}")
    if code_or_name in _TIER_BY_CODE:
        return _TIER_BY_CODE[code_or_name]
    raise ValueError(f"unknown tier code {code_or_name!r}")


def next_tier(code_or_name) -> Tier:
    """The tier a rollup of ``code_or_name`` produces; MONTH has none."""
    t = tier(code_or_name)
    if t.code + 1 not in _TIER_BY_CODE:
        raise ValueError(f"tier {t.name} has no coarser tier to roll up into")
    return _TIER_BY_CODE[t.code + 1]


SENSORS = ("tmp", "hmt", "lx")

# One device report as it arrives on the wire (JSON, camelCase names).
REPORT_WIRE = T.StructType([
    T.StructField("siteId", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("data", T.MapType(T.StringType(), T.DoubleType())),
])

# The same report with data kept as raw text (declared Kafka JSON table).
REPORT_WIRE_RAW_DATA = T.StructType(
    [f for f in REPORT_WIRE.fields if f.name != "data"]
    + [T.StructField("data", T.StringType())])

RULE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("open", T.IntegerType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
])
RULES = T.MapType(T.StringType(), RULE)

# One site's threshold configuration (table row form; rules as JSON text).
CONFIG_ROW = T.StructType([
    T.StructField("site_id", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("is_delete", T.IntegerType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("interval", T.IntegerType()),
    T.StructField("monitor_items", T.StringType()),
])

# Whole configuration as one JSON message (change stream).
CONFIG_WIRE = T.StructType([
    T.StructField("siteId", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("interval", T.IntegerType()),
    T.StructField("isDelete", T.IntegerType()),
    T.StructField("monitorItems", RULES),
])

ALARM_WIRE = T.StructType([
    T.StructField("dataReport", REPORT_WIRE),
    T.StructField("monitorItem", RULE),
])

# Averaged tier row (table dev_avg_data); unique key (site_id, end_time, type).
AVG_ROW = T.StructType([
    T.StructField("site_id", T.IntegerType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("type", T.IntegerType()),
    T.StructField("avg_tmp", T.DoubleType()),
    T.StructField("avg_hmt", T.DoubleType()),
    T.StructField("avg_lx", T.DoubleType()),
])
AVG_KEYS = ("site_id", "end_time", "type")

# Click record of the demos.
EVENT = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])
