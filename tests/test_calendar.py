"""Calendar expressions against a brute-force Python calendar over ten years,
plus the edge dates, elapsed-time text and period spines."""

import datetime as dt

from pyspark.sql import functions as F

from sitewatch.functions import calendar as C
from sitewatch.operators.calendar_jobs import period_counts, period_span, trailing_cutoff


def _sun_dow(d):  # 1 = Sunday .. 7 = Saturday
    return (d.weekday() + 1) % 7 + 1


def _week_of_month(d):
    first = d.replace(day=1)
    return (d.day + _sun_dow(first) - 2) // 7 + 1


def _week_of_year(d):
    # US rule: week 1 holds 1 January; weeks start on Sunday
    saturday = d + dt.timedelta(days=7 - _sun_dow(d))
    if saturday.year > d.year:
        return 1
    jan1 = d.replace(month=1, day=1)
    return (d.timetuple().tm_yday + _sun_dow(jan1) - 2) // 7 + 1


def test_week_columns_brute_force(spark):
    start = dt.date(2019, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(3653)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select("d", C.week_of_month("d").alias("wom"), C.week_of_year("d").alias("woy"),
                    C.week_first_day("d").alias("sun"), C.week_last_day("d").alias("sat"),
                    C.week_monday("d").alias("mon"), C.week_end_sunday("d").alias("nsun"),
                    C.weekday_cn("d").alias("cn")).collect()
    cn = "日一二三四五六"
    for r in out:
        d = r.d
        dow = _sun_dow(d)
        assert r.wom == _week_of_month(d), d
        assert r.woy == _week_of_year(d), d
        assert r.sun == d - dt.timedelta(days=dow - 1)
        assert r.sat == d + dt.timedelta(days=7 - dow)
        assert r.mon == d + dt.timedelta(days=2 - dow)
        assert r.nsun == d + dt.timedelta(days=8 - dow)
        assert r.cn == cn[dow - 1]


def test_edge_dates(spark):
    cases = {dt.date(2023, 1, 1): 1, dt.date(2023, 4, 5): 2, dt.date(2023, 12, 31): 6,
             dt.date(2024, 2, 29): 5}
    df = spark.createDataFrame([(d,) for d in cases], "d date")
    got = {r.d: (r.wom, r.dim, r.last) for r in df.select(
        "d", C.week_of_month("d").alias("wom"), C.days_in_month("d").alias("dim"),
        C.is_last_day_of_month("d").alias("last")).collect()}
    assert {d: v[0] for d, v in got.items()} == cases
    assert got[dt.date(2024, 2, 29)][1:] == (29, True)
    assert got[dt.date(2023, 1, 1)][2] is False
    assert df.select(C.weekday_cn(F.lit("2023-01-01").cast("date"))).first()[0] == "日"
    feb = spark.createDataFrame([(dt.date(2024, 2, 10),)], "d date") \
        .select(C.month_day_numbers("d")).first()[0]
    assert feb == list(range(1, 30))


def test_shifted_text(spark):
    df = spark.createDataFrame([("2024-01-31",), ("2023-12",)], "s string")
    got = [r[0] for r in df.select(C.next_period_text("s")).collect()]
    assert got == ["2024-02-01", "2024-01"]
    d = spark.createDataFrame([(dt.date(2024, 1, 31),)], "d date")
    r = d.select(C.month_text("d", 1), C.month_text("d", -1),
                 C.day_before_months_later("d", 1), C.year_text("d", -1)).first()
    assert tuple(r) == ("2024-02", "2023-12", dt.date(2024, 2, 28), "2023")


def _java_elapsed(ms):
    def tdiv(a, b):
        q = abs(a) // b
        return q if a >= 0 else -q

    def trem(a, b):
        return a - tdiv(a, b) * b
    nd, nh, nm = 86_400_000, 3_600_000, 60_000
    return f"{tdiv(ms, nd)}天{tdiv(trem(ms, nd), nh)}小时{tdiv(trem(trem(ms, nd), nh), nm)}分钟"


def test_elapsed_text_truncates_like_java(spark):
    base = dt.datetime(2024, 1, 1)
    deltas = [0, 59_999, 60_000, 90_061_000, -90_061_000, -1, 3 * 86_400_000 + 5 * 60_000]
    rows = [(base, base + dt.timedelta(milliseconds=m)) for m in deltas]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp")
    got = [r[0] for r in df.select(C.elapsed_text("a", "b")).collect()]
    assert got == [_java_elapsed(m) for m in deltas]
    cmp = spark.createDataFrame([(1, 2), (2, 2), (3, 2)], "a int, b int") \
        .select(C.order_text("a", "b")).collect()
    assert [r[0] for r in cmp] == ["xiaoyu", "dengyu", "dayu"]


def test_month_spine_fills_gaps(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 15),), (dt.date(2023, 1, 20),),
                                (dt.date(2023, 4, 1),)], "d date")
    got = [(r.period_text, r.n_rows) for r in
           period_counts(df, "d", "month").orderBy("period").collect()]
    assert got == [("2023-01", 2), ("2023-02", 0), ("2023-03", 0), ("2023-04", 1)]
    years = [(r.period_text, r.n_rows) for r in period_counts(df, "d", "year").collect()]
    assert years == [("2023", 3)]
    assert period_span(df, "d", "month").first().n_periods == 4
    assert period_span(df, "d", "year").first().n_periods == 1
    wide = spark.createDataFrame([(dt.date(2019, 12, 31),), (dt.date(2023, 1, 1),)], "d date")
    assert period_span(wide, "d", "month").first().n_periods == 38
    assert period_span(wide, "d", "year").first().n_periods == 5


def test_trailing_cutoff_anchor(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, base + dt.timedelta(minutes=10 * i)) for i in range(10)],
                               "i int, ts timestamp")
    got = sorted(r.i for r in trailing_cutoff(df, "ts", 30).collect())
    assert got == [6, 7, 8, 9]
