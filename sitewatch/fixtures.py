"""Adapter views over the driver's parquet tables (see FIXTURES.md).

``events`` carries the sensor reports: site = user_id % 8 + 1, tmp = value,
hmt = k/100, lx = k*10 with k taken from ``props``. Everything here is a lazy
DataFrame derived from the given tables, so work grows with them; the only
inline data are the 8-site threshold table. Malformed lines are made from every
event by a dozen forms, so the quarantines grow with the table.
"""

from __future__ import annotations

import re
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatch import schemas as S
from sitewatch.functions.json import readings_map, report_struct, to_json_text

N_SITES = 8

# ---------------------------------------------------------------------------
# Threshold configuration, one row per site (site 8 has none).
# (site_id, is_delete, interval, rules as {sensor: (open, max, min)})
SITE_RULES = (
    (1, 0, 30, {"tmp": (1, 100.0, 0.0), "hmt": (1, 0.9, 0.1)}),
    (2, 0, 30, {"tmp": (1, 50.0, 5.0)}),
    (3, 0, 30, {"co2": (1, 1.0, 0.0)}),
    (4, 0, 30, {"hmt": (1, 0.5, 0.5)}),
    (5, 1, 30, {"tmp": (1, 1.0, 0.0)}),
    (6, 0, 0, {"tmp": (1, 1.0, 0.0)}),
    (7, 0, 30, {"tmp": (0, 1.0, 0.0), "lx": (1, 900.0, 0.0)}),
)
SITE_RULES_BYTES = 4096  # more than the rows of SITE_RULES take
CONFIG_TIMESTAMP_MS = 1704067200000  # 2024-01-01 00:00:00 UTC

# Forms of malformed and edge lines; {site} and {ts} are the event's.
# Every event gives one line of each kind, in form event_id % number of forms.
# (form, reason it is set aside for, or None if it is accepted)
BAD_REPORT_FORMS = (
    # accepted: trailing text after the object is ignored (as Jackson does)
    ('{"siteId":{site},"timestamp":{ts},"type":"report","version":1,"status":0,'
     '"data":{"tmp":20.5,"hmt":0.5,"lx":100.0}} trailing', None),
    ("not json {ts}", "malformed"),
    ("", "malformed"),
    ("null", "malformed"),
    ("[]", "malformed"),
    ("{}", "missing_site_or_time"),
    ('{"siteId":{site},"timestamp":{ts},"type":"report","version":1,"status":0,'
     '"data":{"tmp":NaN}}', "malformed"),
    ('{"siteId":"{site}","timestamp":{ts},"type":"report","version":1,"status":0}',
     "malformed"),
    ('{"siteId":{site}.7,"timestamp":{ts},"type":"report","version":1,"status":0}',
     "malformed"),
    ('{"timestamp":{ts},"type":"report","version":1,"status":0}', "missing_site_or_time"),
    ('{"siteId":{site},"type":"report","version":1,"status":0}', "missing_site_or_time"),
    # accepted: unknown field ignored, NULL data means "no readings"
    ('{"siteId":{site},"timestamp":{ts},"type":"report","version":1,"status":0,'
     '"data":null,"extra":1}', None),
)
BAD_CSV_FORMS = (
    ("{site}, ./home", "too_few_fields"),
    ("{site}", "too_few_fields"),
    ("{site}, ./home, {ts}x", "bad_timestamp"),
    ("{site} ,./home,", "bad_timestamp"),
)
BAD_CONFIG_FORMS = (
    ("not json {ts}", "malformed"),
    ('{"timestamp":{ts},"version":1}', "missing_site"),
    ('{"siteId":"{site}","timestamp":{ts}}', "malformed"),
)
# ---------------------------------------------------------------------------


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, float):
        return f"{v!r}D"
    return str(v)


def literal_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small inline table (an SQL ``VALUES`` list: a local relation built in
    one statement, no Python worker and no RDD of pickled rows)."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    values = ", ".join(
        "(" + ", ".join(f"CAST({_sql_literal(v)} AS {t})" for (_, t), v in zip(fields, row))
        + ")" for row in rows)
    names = ", ".join(f"`{n}`" for n, _ in fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


_TABLES: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables. The reader (and its file listing) is
    reused per session: the fixture tables are read-only."""
    path = f"{sf_dir}/{name}.parquet"
    cache = _TABLES.setdefault(spark, {})
    if path not in cache:
        cache[path] = spark.read.parquet(path)
    return cache[path]


# k of the events' ``props`` JSON, and the event time as an instant
_K = "try_cast(get_json_object(props, '$.k') AS INT)"
_TS = "CAST(ts AS TIMESTAMP)"
# arrival number of an event's config change: each four events last first
ARRIVAL_SQL = "event_id + 3 - 2 * (event_id % 4)"


def reports(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    """Flattened reports: report_id, site_id, timestamp(ms), ts, type, version,
    status, tmp, hmt, lx (+ ``keep`` columns of ``events``)."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS report_id",
        f"CAST(user_id % {N_SITES} + 1 AS INT) AS site_id",
        f"unix_millis({_TS}) AS timestamp",
        f"{_TS} AS ts",
        "'report' AS type", "1 AS version", "0 AS status",
        "value AS tmp",
        f"CAST({_K} AS DOUBLE) / 100 AS hmt",
        f"CAST({_K} AS DOUBLE) * 10 AS lx",
        *keep)


def reports_with_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with the reference's ``data`` map next to the flat columns."""
    return reports(spark, sf_dir).withColumn("data", readings_map())


def reports_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire form of every report: one JSON text per report (``value``)."""
    return reports_with_data(spark, sf_dir).select(
        to_json_text(report_struct()).alias("value"))


def form_sql(forms, site: str = "site_id", ts: str = '"timestamp"') -> str:
    """SQL (Spark and DuckDB): the event's line in the form its ``event_id`` falls on."""
    cases = []
    for i, (form, _) in enumerate(forms):
        parts = re.split(r"(\{site\}|\{ts\})", form)
        columns = {"{site}": site, "{ts}": ts}
        sql = " || ".join(f"CAST({columns[x]} AS STRING)" if x in columns else f"'{x}'"
                          for x in parts if x) or "''"
        cases.append(f"WHEN {i} THEN {sql}")
    return f"CASE event_id % {len(forms)} {' '.join(cases)} END"


def bad_lines(spark: SparkSession, sf_dir: str, forms) -> DataFrame:
    """One malformed or edge line per event: event_id, value."""
    own = reports(spark, sf_dir).withColumnRenamed("report_id", "event_id")
    return own.selectExpr("event_id", form_sql(forms, ts="timestamp") + " AS value")


def reports_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire form of every report plus a malformed or edge line for each."""
    return reports_wire(spark, sf_dir).unionByName(
        bad_lines(spark, sf_dir, BAD_REPORT_FORMS).select("value"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events of the demos: event_id, user, url, ts, timestamp(ms)."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(user_id AS STRING) AS `user`",
        "concat('./', event_type) AS url", f"{_TS} AS ts",
        f"unix_millis({_TS}) AS timestamp")


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as ``user , url, timestamp`` text lines (padding exercises trim),
    plus a bad line for each."""
    good = clicks(spark, sf_dir).selectExpr(
        "event_id", "concat(`user`, ' ,', url, ', ', CAST(timestamp AS STRING)) AS value")
    return good.unionByName(bad_lines(spark, sf_dir, BAD_CSV_FORMS))


def site_configs(spark: SparkSession) -> DataFrame:
    """The fixed 8-site threshold table in config-row form (JSON rules)."""
    import json
    rows = []
    for seq, (site, is_delete, interval, rules) in enumerate(SITE_RULES):
        items = {name: {"type": name, "open": o, "max": mx, "min": mn}
                 for name, (o, mx, mn) in rules.items()}
        rows.append((seq, site, CONFIG_TIMESTAMP_MS, is_delete, 1, interval,
                     json.dumps(items, separators=(",", ":"))))
    schema = ("config_id long, site_id int, timestamp long, is_delete int, "
              "version int, interval int, monitor_items string")
    return literal_rows(spark, rows, schema)


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A config change log derived from every event (grows with data).

    config_id (arrival order), site_id, ts, timestamp, version, interval,
    is_delete, monitor_items (JSON rules for tmp, hmt, lx). Changes arrive in an
    order of their own: each four events arrive last first.
    """
    def rule(name, open_, mx, mn):
        return (f"'{name}', named_struct('type', '{name}', 'open', CAST({open_} AS INT), "
                f"'max', CAST({mx} AS DOUBLE), 'min', CAST({mn} AS DOUBLE))")
    items = ("map(" + rule("tmp", "1", "value", f"CAST({_K} AS DOUBLE) / 10") + ", "
             + rule("hmt", f"{_K} % 2", "0.9", "0.1") + ", "
             + rule("lx", "1", f"CAST({_K} AS DOUBLE) * 10", "0.0") + ")")
    return table(spark, sf_dir, "events").selectExpr(
        f"{ARRIVAL_SQL} AS config_id",
        f"CAST(user_id % {N_SITES} + 1 AS INT) AS site_id",
        f"{_TS} AS ts", f"unix_millis({_TS}) AS timestamp",
        f"{_K} AS version",
        f"CASE WHEN {_K} % 10 = 0 THEN 0 ELSE 30 END AS `interval`",
        f"CASE WHEN {_K} % 25 = 0 THEN 1 ELSE 0 END AS is_delete",
        f"to_json({items}, map('ignoreNullFields', 'false')) AS monitor_items")


def config_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The config change log as wire JSON messages (``value``), one per
    change, with its arrival order (``config_id``) as a topic offset would, plus
    a bad message for each (``config_id`` negative)."""
    c = config_changes(spark, sf_dir)
    msg = F.struct(F.col("site_id").alias("siteId"), F.col("timestamp"),
                   F.col("version"), F.col("interval"), F.col("is_delete").alias("isDelete"),
                   F.from_json("monitor_items", S.RULES).alias("monitorItems"))
    bad = bad_lines(spark, sf_dir, BAD_CONFIG_FORMS)
    return c.select("config_id", to_json_text(msg).alias("value")).unionByName(
        bad.selectExpr("-1 - event_id AS config_id", "value"))


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, d`` (DATE) for the calendar jobs."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
