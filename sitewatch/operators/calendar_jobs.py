"""Calendar jobs over a table (CAL-2 period spines, CAL-4 trailing cutoff).

The table is read once: facts are aggregated per period (map-side partial
aggregation), and the spine and its bounds come from those facts, which the
calendar bounds, not the row count. Empty periods show up with zero counts
instead of being missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatch.sources.footers import stored_max

_UNITS = {"month": ("MM", "1 month", "yyyy-MM"), "year": ("YEAR", "1 year", "yyyy")}


def period_spine(df: DataFrame, date_col: str, unit: str = "month") -> DataFrame:
    """Every period (first day, DATE) between the min and max of ``date_col``
    inclusive: ``period``, ``period_text`` (``yyyy-MM`` or ``yyyy``)."""
    trunc_unit, step, fmt = _UNITS[unit]
    d = F.col(date_col).cast("date")
    bounds = df.agg(F.trunc(F.min(d), trunc_unit).alias("lo"),
                    F.trunc(F.max(d), trunc_unit).alias("hi"))
    spine = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias("period"))
    return spine.select("period", F.date_format("period", fmt).alias("period_text"))


def period_span(df: DataFrame, date_col: str, unit: str = "month") -> DataFrame:
    """Number of periods from the first to the last ``date_col`` inclusive
    (one row, ``n_periods``): a global min/max aggregate, no spine needed."""
    trunc_unit = _UNITS[unit][0]
    d = F.col(date_col).cast("date")
    lo, hi = F.trunc(F.min(d), trunc_unit), F.trunc(F.max(d), trunc_unit)
    months = F.months_between(hi, lo).cast("int")
    n = months + 1 if unit == "month" else (months / 12).cast("int") + 1
    return df.agg(n.alias("n_periods"))


def period_counts(df: DataFrame, date_col: str, unit: str = "month",
                  measures: dict[str, Column] | None = None) -> DataFrame:
    """Gap-free per-period facts: every period between the first and the last,
    with its aggregates; periods without rows get ``n_rows = 0`` and NULL measures."""
    trunc_unit, step, fmt = _UNITS[unit]
    names = ["n_rows", *(measures or {})]
    facts = (df.groupBy(F.trunc(F.col(date_col).cast("date"), trunc_unit).alias("period"))
               .agg(F.count(F.lit(1)).alias("n_rows"),
                    *[m.alias(name) for name, m in (measures or {}).items()])
               .where(F.col("period").isNotNull()))
    # one row that holds all facts: at most one entry per period of the calendar
    held = facts.agg(F.min("period").alias("lo"), F.max("period").alias("hi"),
                     F.map_from_entries(F.collect_list(
                         F.struct("period", F.struct(*names)))).alias("facts"))
    spine = held.where(F.col("lo").isNotNull()).select("facts", F.explode(
        F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias("period"))
    own = spine.withColumn("_f", F.try_element_at("facts", F.col("period")))
    return own.select("period", F.date_format("period", fmt).alias("period_text"),
                      F.coalesce(F.col("_f.n_rows"), F.lit(0)).alias("n_rows"),
                      *[F.col(f"_f.{n}").alias(n) for n in names[1:]])


# Units of a trailing cutoff -> SQL interval of one of them.
_CUTOFF_UNITS = {"minute": "MINUTE", "hour": "HOUR", "day": "DAY", "week": "WEEK",
                 "month": "MONTH", "year": "YEAR"}


def trailing_cutoff(df: DataFrame, ts: str, amount: int, unit: str = "minute",
                    anchor: Column | None = None, path: str | None = None) -> DataFrame:
    """CAL-4: rows with ``ts >= anchor - amount units``. The default anchor is the
    table's own latest ``ts`` instead of the wall clock, so the result is reproducible.

    ``path``: the Parquet files that ``df`` reads, all rows of them. The latest ``ts`` then
    comes from their footers and no column is scanned for it; where footers do not tell,
    and without ``path``, an aggregate finds it. With ``path``, ``df`` may be a stream over
    files whose rows are compared with the latest ``ts`` stored at the start.

    The cutoff is a constant of the stored column's own type, so the comparison reaches
    the scan and row groups before the cutoff are skipped: pass the stored column, not
    a cast.
    """
    if unit not in _CUTOFF_UNITS:
        raise ValueError(f"unknown unit {unit!r}")
    kind = df.schema[ts].dataType
    step = F.expr(f"INTERVAL {int(amount)} {_CUTOFF_UNITS[unit]}")
    latest = stored_max(df.sparkSession, path, ts, kind) if path and anchor is None else None
    if latest is not None:
        return df.where(F.col(ts) >= (latest - step).cast(kind))
    cutoff = ((F.max(ts) if anchor is None else F.max(anchor)) - step).cast(kind)
    found = df.agg(cutoff.cast("string").alias("cutoff")).first()["cutoff"]
    return df.where(F.col(ts) >= F.lit(found).cast(kind))
