"""DuckDB SQL equal to each registered query (the correctness oracle).

Only the base parquet tables exist on the DuckDB side, so every statement
re-derives the adapter views of ``sitewatch.fixtures`` as CTEs.
"""

from __future__ import annotations

from sitewatch import fixtures as FX
from sitewatch import schemas as S

REPORTS = """reports AS (
  SELECT event_id AS report_id,
         CAST(user_id % 8 + 1 AS INTEGER) AS site_id,
         epoch_us(ts) // 1000 AS "timestamp", ts,
         'report' AS type, 1 AS version, 0 AS status,
         value AS tmp,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / 100 AS hmt,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) * 10 AS lx,
         event_type
  FROM events)"""

CLICKS = """clicks AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS "user", './' || event_type AS url,
         ts, epoch_us(ts) // 1000 AS "timestamp"
  FROM events)"""

CONFIG_CHANGES = f"""config_changes AS (
  SELECT {FX.ARRIVAL_SQL} AS config_id, CAST(user_id % 8 + 1 AS INTEGER) AS site_id,
         ts, epoch_us(ts) // 1000 AS "timestamp", k AS version,
         CASE WHEN k % 10 = 0 THEN 0 ELSE 30 END AS "interval",
         CASE WHEN k % 25 = 0 THEN 1 ELSE 0 END AS is_delete,
         value AS tmp_max, CAST(k AS DOUBLE) / 10 AS tmp_min, 1 AS tmp_open,
         CAST(0.9 AS DOUBLE) AS hmt_max, CAST(0.1 AS DOUBLE) AS hmt_min, k % 2 AS hmt_open,
         CAST(k AS DOUBLE) * 10 AS lx_max, CAST(0.0 AS DOUBLE) AS lx_min, 1 AS lx_open
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events))"""

BAD_LINES = """bad_lines AS (
  SELECT event_id, site_id, "timestamp", {line} AS value, event_id % {n} AS form
  FROM (SELECT event_id, CAST(user_id % 8 + 1 AS INTEGER) AS site_id,
               epoch_us(ts) // 1000 AS "timestamp" FROM events))"""


def bad_lines(forms) -> str:
    """CTE of every event's malformed or edge line."""
    return BAD_LINES.format(line=FX.form_sql(forms), n=len(forms))


def rejected(forms, key: str = "") -> str:
    """Lines set aside with their reason; ``key``: leading columns."""
    reasons = " ".join(f"WHEN {i} THEN '{r}'" for i, (_, r) in enumerate(forms) if r)
    kept = ", ".join(str(i) for i, (_, r) in enumerate(forms) if r)
    return (f"SELECT {key}value, CASE form {reasons} END AS reject_reason FROM bad_lines "
            f"WHERE form IN ({kept})")


def _num(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def site_rules_values() -> str:
    """The fixed 8-site threshold table, one row per (site, rule)."""
    rows = []
    for seq, (site, is_delete, interval, rules) in enumerate(FX.SITE_RULES):
        for name, (o, mx, mn) in rules.items():
            rows.append(f"({seq}, {site}, {is_delete}, {interval}, '{name}', {o}, "
                        f"{_num(mx)}, {_num(mn)})")
    return ("site_rules(config_id, site_id, is_delete, \"interval\", sensor, open, "
            "max, min) AS (VALUES " + ",\n  ".join(rows) + ")")


def bucket_end(ts: str, minutes: int) -> str:
    return (f"time_bucket(INTERVAL '{minutes} minutes', {ts}, TIMESTAMP '1970-01-01')"
            f" + INTERVAL '{minutes} minutes'")


# Readings and their averages are whole numbers of 2**-FINE (checked), far below 2**127.
FINE = 80


def exact_avg(col: str) -> str:
    """The exact sum as a 128-bit number of 2**-FINE, correctly rounded to double (by way
    of its text), divided by the count."""
    units = f"{col} * pow(2, {FINE})"
    return (f"CAST(CAST(SUM(CASE WHEN {units} <> floor({units}) THEN error('finer than the unit') "
            f"ELSE CAST({units} AS HUGEINT) END) AS VARCHAR) AS DOUBLE)"
            f" / pow(2, {FINE}) / COUNT({col})")


def tier_cte(name: str, code: int, source: str = "reports") -> str:
    t = S.tier(code)
    return f"""{name} AS (
  SELECT site_id, {bucket_end('ts', t.minutes)} AS end_time, {t.code} AS type,
         {exact_avg('tmp')} AS avg_tmp, {exact_avg('hmt')} AS avg_hmt,
         {exact_avg('lx')} AS avg_lx
  FROM {source} GROUP BY ALL)"""


def rollup_sql(code: int, end_stamped: bool = False) -> str:
    src, dst = S.tier(code), S.next_tier(code)
    et = "end_time - INTERVAL 1 MICROSECOND" if end_stamped else "end_time"
    return f"""WITH {REPORTS},
{tier_cte('src', src.code)}
SELECT site_id, {bucket_end(et, dst.minutes)} AS end_time, {dst.code} AS type,
       {exact_avg('avg_tmp')} AS avg_tmp, {exact_avg('avg_hmt')} AS avg_hmt,
       {exact_avg('avg_lx')} AS avg_lx
FROM src GROUP BY ALL"""
