"""Keyed upsert and purge as table-to-table DataFrame operations.

SNK-2 (``insert ... on duplicate key update``) on immutable files becomes one
keyed pick over old rows and updates, in which an update beats an old row: each
side is read once and shuffled once on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.operators.latest import latest_per_key


def dedupe_updates(updates: DataFrame, keys, order: str | None) -> DataFrame:
    """Within one batch, the last update per key wins (by ``order``)."""
    if order is None:
        return updates
    keys = list(keys)
    rest = [c for c in updates.columns if c not in keys]
    key = "_upsert_key"
    packed = updates.select(F.struct(*keys).alias(key), *rest)
    latest = latest_per_key(packed, key, order=(order,))
    return latest.select(f"{key}.*", *rest)


def upsert(current: DataFrame, updates: DataFrame, keys,
           order: str | None = None) -> DataFrame:
    """Rows of ``current`` not keyed in ``updates``, plus ``updates``.

    ``order``: column deciding between several updates of one key in the same
    batch (last wins); without it, updates must already be unique per key.
    NULL key values are equal to each other.
    """
    updates = dedupe_updates(updates, list(keys), order).select(*current.columns)
    return pick_updates(current.withColumn("_is_new", F.lit(0))
                        .unionByName(updates.withColumn("_is_new", F.lit(1))), keys)


def pick_updates(rows: DataFrame, keys, flag: str = "_is_new") -> DataFrame:
    """One row per key: the one with the greatest ``flag`` (1 for an update)."""
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys and c != flag]
    best = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.col(flag)).alias("_row"))
    columns = [c for c in rows.columns if c != flag]
    return best.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c)
                         for c in columns])


def purge(df: DataFrame, column: str, values) -> DataFrame:
    """SNK-11: ``delete from t where column in (values)`` as the next version."""
    values = list(values)
    return df.where(~F.col(column).isin(values) | F.col(column).isNull())
