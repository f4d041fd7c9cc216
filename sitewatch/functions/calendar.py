"""Calendar expressions over a date/timestamp column (CAL-1, CAL-3, CAL-5).

The reference's date helper works on one string at a time and reads "now";
here each helper is a Column expression applied to a table column (or to an
anchor column), so it runs inside whole-stage codegen over the whole table.
Weeks are Sunday-first with week 1 holding 1 January (a US-style calendar).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewatch import schemas as S


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- CAL-1a: weeks ----------------------------------------------------------

def week_of_month(d) -> Column:
    """Week of the month, Sunday-first, the 1st always in week 1."""
    d = _col(d)
    return ((F.dayofmonth(d) + F.dayofweek(F.trunc(d, "MM")) + 5) / 7).cast("int")


def week_first_day(d) -> Column:
    """The Sunday that starts ``d``'s week."""
    d = _col(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_last_day(d) -> Column:
    """The Saturday that ends ``d``'s week."""
    d = _col(d)
    return F.date_add(d, 7 - F.dayofweek(d))


def week_monday(d) -> Column:
    """Monday of ``d``'s Sunday-first week (a Sunday gets the next day)."""
    d = _col(d)
    return F.date_add(d, 2 - F.dayofweek(d))


def week_end_sunday(d) -> Column:
    """The Sunday after ``d``'s week's Saturday."""
    d = _col(d)
    return F.date_add(d, 8 - F.dayofweek(d))


def week_of_year(d) -> Column:
    """Week of the year: Sunday-first, week 1 is the week holding 1 January,
    so the last days of December can be week 1 of the next year.
    (Not ``weekofyear``, which is ISO.)"""
    d = _col(d)
    spills = F.year(week_last_day(d)) > F.year(d)
    regular = ((F.dayofyear(d) + F.dayofweek(F.trunc(d, "YEAR")) + 5) / 7).cast("int")
    return F.when(spills, F.lit(1)).otherwise(regular)


def weekday_cn(d) -> Column:
    """Weekday as one Chinese character, Sunday = 日."""
    return F.element_at(F.array(*[F.lit(c) for c in S.WEEKDAY_CN]), F.dayofweek(_col(d)))


# -- CAL-1b: months ---------------------------------------------------------

def days_in_month(d) -> Column:
    return F.dayofmonth(F.last_day(_col(d)))


def is_last_day_of_month(d) -> Column:
    d = _col(d)
    return d == F.last_day(d)


def month_day_numbers(d) -> Column:
    """``[1, 2, ..., days in month]``."""
    return F.sequence(F.lit(1), days_in_month(d))


# -- CAL-1c: shifted dates --------------------------------------------------

def month_text(d, months: int = 0) -> Column:
    """``yyyy-MM`` of ``d`` shifted by ``months`` (end-of-month clamped)."""
    d = _col(d)
    return F.date_format(F.add_months(d, months) if months else d, "yyyy-MM")


def year_text(d, years: int = 0) -> Column:
    d = _col(d)
    return F.date_format(F.add_months(d, 12 * years) if years else d, "yyyy")


def day_before_months_later(d, months: int) -> Column:
    """``d`` plus ``months`` months, minus one day."""
    return F.date_sub(F.add_months(_col(d), months), 1)


def next_period_text(s) -> Column:
    """Text ``yyyy-MM-dd`` -> next day; text ``yyyy-MM`` -> next month."""
    s = _col(s)
    return F.when(F.length(s) > 7, F.date_format(
        F.date_add(F.to_date(s, "yyyy-MM-dd"), 1), "yyyy-MM-dd")).otherwise(
        F.date_format(F.add_months(F.to_date(s, "yyyy-MM"), 1), "yyyy-MM"))


# -- CAL-3: elapsed time and order ------------------------------------------

def elapsed_text(start, end) -> Column:
    """``<d>天<h>小时<m>分钟`` between two timestamps: whole minutes, rounded toward
    zero, as days and a clock time; a negative span has the sign on every part."""
    span = F.unix_millis(_col(end).cast("timestamp")) - F.unix_millis(
        _col(start).cast("timestamp"))
    minutes = F.floor(F.abs(span) / 60_000).cast("long")
    day, clock = F.floor(minutes / 1440).cast("long"), minutes % 1440
    parts = [day, F.floor(clock / 60).cast("long"), clock % 60]
    sign = F.when(span < 0, F.lit(-1)).otherwise(F.lit(1))
    return F.concat(*[x for part, word in zip(parts, ("天", "小时", "分钟"))
                      for x in ((part * sign).cast("string"), F.lit(word))])


def order_text(a, b) -> Column:
    """``dengyu`` when equal, ``xiaoyu`` when a < b, ``dayu`` when a > b."""
    a, b = _col(a), _col(b)
    return (F.when(a == b, F.lit(S.CMP_EQUAL)).when(a < b, F.lit(S.CMP_LESS))
             .when(a > b, F.lit(S.CMP_GREATER)))


# -- CAL-5: text and epoch conversions --------------------------------------

def datetime_text(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def date_text(ts, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_col(ts), pattern)


def nian_yue(ts) -> Column:
    return F.date_format(_col(ts), "yyyy'年'MM'月'")


def nian_yue_ri(ts) -> Column:
    return F.date_format(_col(ts), "yyyy'年'MM'月'dd'日'")


def epoch_seconds(ts) -> Column:
    return F.unix_seconds(_col(ts).cast("timestamp"))


def seconds_text(seconds) -> Column:
    return F.date_format(F.timestamp_seconds(_col(seconds)), "yyyy-MM-dd HH:mm:ss")


def millis_text(ms) -> Column:
    return F.date_format(F.timestamp_millis(_col(ms)), "yyyy-MM-dd HH:mm:ss")


def reformat(text, pattern_in: str, pattern_out: str) -> Column:
    """Re-render date text read with an explicit input pattern."""
    return F.date_format(F.to_timestamp(_col(text), pattern_in), pattern_out)
