"""Calendar queries over order dates and event times (CAL-1..CAL-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewatch import fixtures as FX
from sitewatch.functions import calendar as C
from sitewatch.operators.calendar_jobs import period_counts, period_span, trailing_cutoff
from sitewatch.operators.windows import as_ntz
from sitewatch.plans.catalog import register

DOW = "(dayofweek(d) + 1)"  # DuckDB counts Sunday as 0, Spark as 1
DATES = """dates AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""


@register("calendar_week", f"""WITH {DATES}
SELECT o_orderkey, d,
  CAST((day(d) + dayofweek(CAST(date_trunc('month', d) AS DATE)) + 6) // 7 AS INTEGER)
    AS week_of_month,
  d - CAST({DOW} - 1 AS INTEGER) AS week_first_day,
  d + CAST(7 - {DOW} AS INTEGER) AS week_last_day,
  d + CAST(2 - {DOW} AS INTEGER) AS week_monday,
  d + CAST(8 - {DOW} AS INTEGER) AS week_end_sunday,
  CAST(CASE WHEN year(d + CAST(7 - {DOW} AS INTEGER)) > year(d) THEN 1
       ELSE (dayofyear(d) + dayofweek(CAST(date_trunc('year', d) AS DATE)) + 6) // 7
       END AS INTEGER) AS week_of_year,
  ['日', '一', '二', '三', '四', '五', '六'][{DOW}] AS weekday_cn
FROM dates""")
def q_calendar_week(spark, sf_dir):
    """CAL-1a: week-of-month, Sunday/Saturday bounds, Monday/Sunday bounds,
    US week-of-year and the weekday character of every order date."""
    d = FX.order_dates(spark, sf_dir)
    return d.select("o_orderkey", "d",
                    C.week_of_month("d").alias("week_of_month"),
                    C.week_first_day("d").alias("week_first_day"),
                    C.week_last_day("d").alias("week_last_day"),
                    C.week_monday("d").alias("week_monday"),
                    C.week_end_sunday("d").alias("week_end_sunday"),
                    C.week_of_year("d").alias("week_of_year"),
                    C.weekday_cn("d").alias("weekday_cn"))


@register("calendar_month", f"""WITH {DATES}
SELECT o_orderkey, d, CAST(day(last_day(d)) AS INTEGER) AS days_in_month,
       last_day(d) AS last_day, d = last_day(d) AS is_last_day,
       array_to_string(range(1, day(last_day(d)) + 1), ',') AS day_numbers
FROM dates""")
def q_calendar_month(spark, sf_dir):
    """CAL-1b: days in month, last day, is-last-day and the day numbers of the
    month of every order date."""
    d = FX.order_dates(spark, sf_dir)
    return d.select("o_orderkey", "d", C.days_in_month("d").alias("days_in_month"),
                    F.last_day("d").alias("last_day"),
                    C.is_last_day_of_month("d").alias("is_last_day"),
                    F.array_join(C.month_day_numbers("d"), ",").alias("day_numbers"))


@register("calendar_shift", f"""WITH {DATES}
SELECT o_orderkey, d,
  strftime(d, '%Y-%m') AS month,
  strftime(d - INTERVAL 1 MONTH, '%Y-%m') AS last_month,
  strftime(d + INTERVAL 1 MONTH, '%Y-%m') AS next_month,
  strftime(d + INTERVAL 3 MONTH, '%Y-%m') AS month_plus_3,
  d + 7 AS date_plus_7,
  d - 150 AS date_minus_150,
  strftime(d - INTERVAL 12 MONTH, '%Y') AS year_back_1,
  CAST(d + INTERVAL 1 MONTH AS DATE) - 1 AS day_before_next_month,
  strftime(d + 1, '%Y-%m-%d') AS next_day_text,
  strftime(d + INTERVAL 1 MONTH, '%Y-%m') AS next_month_text
FROM dates""")
def q_calendar_shift(spark, sf_dir):
    """CAL-1c: previous/next/around month text, shifted days, year back,
    day before next month, next period of date and month text."""
    d = FX.order_dates(spark, sf_dir)
    return d.select("o_orderkey", "d",
                    C.month_text("d").alias("month"),
                    C.month_text("d", -1).alias("last_month"),
                    C.month_text("d", 1).alias("next_month"),
                    C.month_text("d", 3).alias("month_plus_3"),
                    F.date_add("d", 7).alias("date_plus_7"),
                    F.date_sub("d", 150).alias("date_minus_150"),
                    C.year_text("d", -1).alias("year_back_1"),
                    C.day_before_months_later("d", 1).alias("day_before_next_month"),
                    C.next_period_text(F.date_format("d", "yyyy-MM-dd")).alias("next_day_text"),
                    C.next_period_text(C.month_text("d")).alias("next_month_text"))


def _spine_sql(unit, step, fmt):
    return f"""WITH {DATES},
bounds AS (SELECT date_trunc('{unit}', min(d)) AS lo, date_trunc('{unit}', max(d)) AS hi
           FROM dates),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL {step})) AS DATE) AS period
          FROM bounds),
facts AS (SELECT CAST(date_trunc('{unit}', d) AS DATE) AS period, COUNT(*) AS n_rows,
                 min(d) AS first_date, max(d) AS last_date
          FROM dates GROUP BY 1)
SELECT s.period, strftime(s.period, '{fmt}') AS period_text,
       COALESCE(f.n_rows, 0) AS n_rows, f.first_date, f.last_date
FROM spine s LEFT JOIN facts f ON s.period = f.period"""


def _spine(unit):
    def q(spark, sf_dir):
        d = FX.order_dates(spark, sf_dir)
        return period_counts(d, "d", unit, {"first_date": F.min("d"),
                                            "last_date": F.max("d")}).select(
            "period", "period_text", "n_rows", "first_date", "last_date")
    q.__doc__ = f"CAL-2: gap-free {unit} spine of order dates with per-{unit} counts."
    return q


register("month_spine", _spine_sql("month", "1 MONTH", "%Y-%m"))(_spine("month"))
register("year_spine", _spine_sql("year", "1 YEAR", "%Y"))(_spine("year"))


@register("month_count", f"""WITH {DATES}
SELECT CAST(date_diff('month', date_trunc('month', min(d)), date_trunc('month', max(d))) + 1
            AS INTEGER) AS n_periods
FROM dates""")
def q_month_count(spark, sf_dir):
    """CAL-2: number of months from the first to the last order date, inclusive."""
    return period_span(FX.order_dates(spark, sf_dir), "d", "month")


_LINES = """lines AS (
  SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def _order_lines(spark, sf_dir):
    li = FX.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                      "l_shipdate")
    od = FX.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey).drop("o_orderkey")


@register("elapsed_text", f"""WITH {_LINES},
spans AS (SELECT *, CASE WHEN l_shipdate < o_orderdate THEN -1 ELSE 1 END AS sign,
  abs(epoch_ms(l_shipdate) - epoch_ms(o_orderdate)) // 60000 AS minutes FROM lines)
SELECT l_orderkey, l_linenumber, sign * (minutes // 1440) || '天'
  || sign * (minutes // 60 % 24) || '小时' || sign * (minutes % 60) || '分钟' AS elapsed
FROM spans""")
def q_elapsed_text(spark, sf_dir):
    """CAL-3: time from order to shipment as 'd天h小时m分钟' per line item."""
    j = _order_lines(spark, sf_dir)
    return j.select("l_orderkey", "l_linenumber",
                    C.elapsed_text("o_orderdate", "l_shipdate").alias("elapsed"))


@register("date_order", f"""WITH {_LINES}
SELECT l_orderkey, l_linenumber,
  CASE WHEN o_orderdate = l_shipdate THEN 'dengyu'
       WHEN o_orderdate < l_shipdate THEN 'xiaoyu'
       WHEN o_orderdate > l_shipdate THEN 'dayu' END AS cmp
FROM lines""")
def q_date_order(spark, sf_dir):
    """CAL-3: order date compared with ship date (dengyu / xiaoyu / dayu)."""
    j = _order_lines(spark, sf_dir)
    return j.select("l_orderkey", "l_linenumber",
                    C.order_text("o_orderdate", "l_shipdate").alias("cmp"))


def _cutoff(amount, unit):
    def q(spark, sf_dir):
        # the stored column is compared, so the comparison reaches the scan
        out = trailing_cutoff(FX.table(spark, sf_dir, "events"), "ts", amount, unit,
                              path=f"{sf_dir}/events.parquet")
        return out.select("event_id", "user_id", as_ntz("ts").alias("ts"))
    q.__doc__ = f"CAL-4: events of the last {amount} {unit}s before the latest event."
    return q


for _name, _amount, _unit in (("trailing_cutoff", 1440, "minute"),
                              ("trailing_cutoff_hours", 36, "hour"),
                              ("trailing_cutoff_days", 7, "day"),
                              ("trailing_cutoff_months", 1, "month")):
    register(_name, f"""
SELECT event_id, user_id, ts FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {_amount} {_unit}""")(
        _cutoff(_amount, _unit))


@register("time_text", """
SELECT event_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime_text,
  strftime(ts, '%Y-%m-%d') AS date_text,
  strftime(ts, '%Y-%m') AS month_text,
  strftime(ts, '%Y%m%d') AS compact_date,
  strftime(ts, '%Y年%m月') AS nian_yue,
  strftime(ts, '%Y年%m月%d日') AS nian_yue_ri,
  epoch_us(ts) // 1000000 AS epoch_seconds,
  strftime(make_timestamp((epoch_us(ts) // 1000000) * 1000000), '%Y-%m-%d %H:%M:%S')
    AS seconds_text,
  strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S')
    AS millis_text,
  strftime(ts, '%Y%m%d') AS reformatted
FROM events""")
def q_time_text(spark, sf_dir):
    """CAL-5: text and epoch renderings of every event time."""
    ev = FX.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"))
    secs = C.epoch_seconds("ts")
    return ev.select("event_id",
                     C.datetime_text("ts").alias("datetime_text"),
                     C.date_text("ts").alias("date_text"),
                     C.date_text("ts", "yyyy-MM").alias("month_text"),
                     C.date_text("ts", "yyyyMMdd").alias("compact_date"),
                     C.nian_yue("ts").alias("nian_yue"),
                     C.nian_yue_ri("ts").alias("nian_yue_ri"),
                     secs.alias("epoch_seconds"),
                     C.seconds_text(secs).alias("seconds_text"),
                     C.millis_text(F.unix_millis("ts")).alias("millis_text"),
                     C.reformat(C.datetime_text("ts"), "yyyy-MM-dd HH:mm:ss",
                                "yyyyMMdd").alias("reformatted"))
