"""Property tests: exact averages and calendar expressions on random inputs."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from sitewatch.functions import calendar as C
from sitewatch.functions.numeric import average

two_decimals = st.integers(min_value=-10**9, max_value=10**9).map(lambda i: i / 100)
any_double = st.builds(lambda m, e: m * 10.0**e, st.floats(-10, 10).filter(
    lambda m: m == 0 or abs(m) > 1e-3), st.integers(-290, 290))


@settings(max_examples=10, deadline=None)
@given(st.lists(two_decimals, min_size=1, max_size=300)
       | st.lists(any_double, min_size=1, max_size=60), st.integers(1, 9))
def test_average_is_the_rounded_sum_by_the_count(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    got = average(df, [], ["x"]).first().x
    assert got == math.fsum(values) / len(values)


def _sun_dow(d):
    return (d.weekday() + 1) % 7 + 1


def _us_week_of_year(d):
    saturday = d + dt.timedelta(days=7 - _sun_dow(d))
    if saturday.year > d.year:
        return 1
    jan1 = d.replace(month=1, day=1)
    return (d.timetuple().tm_yday + _sun_dow(jan1) - 2) // 7 + 1


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31)),
                min_size=50, max_size=400))
def test_week_of_year_two_centuries(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", C.week_of_year("d").alias("w"),
                       C.week_of_month("d").alias("m")).collect():
        assert r.w == _us_week_of_year(r.d), r.d
        first = r.d.replace(day=1)
        assert r.m == (r.d.day + _sun_dow(first) - 2) // 7 + 1, r.d
