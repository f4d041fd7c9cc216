"""Current value per key (AGG-8 map state, SNK-7 hash upsert).

"Last write wins" is ``max_by(row, order)`` per key: an ordinary aggregate, so
every partition pre-reduces its rows map-side and a hot key costs one row per
partition in the shuffle, never a materialised group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order=("timestamp",)) -> DataFrame:
    """The last row per ``key`` by the ``order`` columns (all columns kept)."""
    order = [order] if isinstance(order, str) else list(order)
    cols = [c for c in df.columns if c != key]
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(key)
              .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), ordering).alias("_v"))
              .select(key, "_v.*"))


def current_value(df: DataFrame, key: str, value: str, order=("timestamp",)) -> DataFrame:
    """SNK-7: ``HSET hash key value`` replayed in order -> (key, value) table."""
    order = [order] if isinstance(order, str) else list(order)
    return (df.groupBy(key)
              .agg(F.max_by(F.col(value), F.struct(*[F.col(c) for c in order]))
                   .alias(value)))
