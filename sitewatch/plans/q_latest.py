"""Queries over current-value tables, keyed upsert and purge
(AGG-8, ST-10, SNK-7, SNK-2, SNK-11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewatch import fixtures as FX
from sitewatch import schemas as S
from sitewatch.operators.latest import current_value, latest_per_key
from sitewatch.functions.numeric import binned_parts, finished
from sitewatch.operators.match import ARRIVAL
from sitewatch.operators.upsert import pick_updates, purge
from sitewatch.operators.windows import as_ntz, tier_table
from sitewatch.plans import oracle as O
from sitewatch.plans.catalog import register


def _rule_json(sensor):
    return (f"'{sensor}': {{'type': '{sensor}', 'open': {sensor}_open, "
            f"'max': {sensor}_max, 'min': {sensor}_min}}")


@register("latest_config", f"""WITH {O.CONFIG_CHANGES}
SELECT site_id, config_id, ts, version, "interval", is_delete,
       to_json(MAP {{{_rule_json('tmp')}, {_rule_json('hmt')}, {_rule_json('lx')}}})::VARCHAR
         AS monitor_items
FROM config_changes
QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY config_id DESC) = 1""")
def q_latest_config(spark, sf_dir):
    """AGG-8 / JN-2: the current config of every site (last to arrive wins)."""
    latest = latest_per_key(FX.config_changes(spark, sf_dir), "site_id", order=ARRIVAL)
    return latest.select("site_id", "config_id", as_ntz("ts").alias("ts"), "version",
                         "interval", "is_delete", "monitor_items")


@register("current_value_by_user", f"""WITH {O.CLICKS}
SELECT "user", url FROM clicks
QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY "timestamp" DESC, event_id DESC) = 1""")
def q_current_value(spark, sf_dir):
    """SNK-7: hash upsert user -> url replayed in event order (last write wins)."""
    return current_value(FX.clicks(spark, sf_dir), "user", "url",
                         order=("timestamp", "event_id"))


_HOUR = S.tier("HOUR")


@register("avg_upsert", f"""WITH {O.REPORTS},
rep_old AS (SELECT * FROM reports WHERE event_type <> 'purchase'),
{O.tier_cte('old', 2, 'rep_old')},
{O.tier_cte('allh', 2, 'reports')},
touched AS (SELECT DISTINCT site_id, {O.bucket_end('ts', 60)} AS end_time
            FROM reports WHERE event_type = 'purchase'),
new AS (SELECT a.* FROM allh a SEMI JOIN touched t
        ON a.site_id = t.site_id AND a.end_time = t.end_time)
SELECT * FROM new
UNION ALL
SELECT * FROM old o WHERE NOT EXISTS (
  SELECT 1 FROM new n
  WHERE n.site_id = o.site_id AND n.end_time = o.end_time AND n.type = o.type)""")
def q_avg_upsert(spark, sf_dir):
    """SNK-2: hourly averages first written without late 'purchase' reports,
    then the windows those reports touch are recomputed and upserted."""
    rep = FX.reports(spark, sf_dir, keep=("event_type",))
    late = F.col("event_type") == "purchase"
    # one pass: each sensor's sums without the late reports, and with all of them
    for sensor in S.SENSORS:
        rep = rep.withColumn(f"old_{sensor}", F.when(~late, F.col(sensor)))
    names = [*S.SENSORS, *[f"old_{s}" for s in S.SENSORS]]
    hours = [F.col("site_id"), F.window("ts", _HOUR.duration).end.alias("end_time"),
             F.lit(_HOUR.code).alias("type")]
    parts = binned_parts(rep, hours, names, [F.bool_or(late).alias("_touched"),
                                             F.bool_or(~late).alias("_was")])
    sums = finished(parts, S.AVG_KEYS, names, [F.bool_or("_touched").alias("_touched"),
                                               F.bool_or("_was").alias("_was")])

    def version(prefix, flag, when):
        averages = [F.col(f"{prefix}{s}").alias(f"avg_{s}") for s in S.SENSORS]
        return F.when(when, F.struct(*averages, F.lit(flag).alias("_is_new")))

    both = sums.select(*S.AVG_KEYS, F.explode(F.array_compact(F.array(
        version("old_", 0, F.col("_was")), version("", 1, F.col("_touched"))))).alias("v"))
    out = pick_updates(both.select(*S.AVG_KEYS, "v.*"), S.AVG_KEYS)
    return out.select("site_id", as_ntz("end_time").alias("end_time"), "type",
                      "avg_tmp", "avg_hmt", "avg_lx")


@register("tier_purge", f"""WITH {O.REPORTS},
{O.tier_cte('t1', 1)}, {O.tier_cte('t2', 2)}, {O.tier_cte('t3', 3)},
{O.tier_cte('t4', 4)}, {O.tier_cte('t5', 5)}
SELECT * FROM (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3
               UNION ALL SELECT * FROM t4 UNION ALL SELECT * FROM t5)
WHERE type NOT IN (1, 2)""")
def q_tier_purge(spark, sf_dir):
    """SNK-11: delete the MINUTE and HOUR tiers from the averaged table."""
    table = tier_table(FX.reports(spark, sf_dir))
    out = purge(table, "type", (1, 2))
    return out.select("site_id", as_ntz("end_time").alias("end_time"), "type",
                      "avg_tmp", "avg_hmt", "avg_lx")
