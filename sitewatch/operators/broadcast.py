"""Broadcast only behind a check of the bytes that would be shipped.

``checked_broadcast`` measures the candidate side (a small job on a small table)
and hints a broadcast only when its bytes are within the bound; beyond it the join
stays a shuffle join that AQE may still convert at runtime (from measured sizes) or
split when skewed. Rows may hold maps of any length, so rows alone bound nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of a per-site config / lookup table we accept to ship to every task.
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD = 64  # pointers and lengths of a row in a hash table


def measured_bytes(df: DataFrame) -> int:
    """The rows' bytes as JSON text (no less than their binary form) with overhead."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    row = df.agg(F.sum(F.octet_length(text) + ROW_OVERHEAD).alias("n")).first()
    return int(row["n"] or 0)


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                      known_bytes: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` has at most ``max_bytes`` bytes, else ``df``.

    ``known_bytes`` skips the measurement when the caller has a proven bound (an
    inline table).
    """
    if df.isStreaming:
        return df
    n = measured_bytes(df) if known_bytes is None else known_bytes
    return F.broadcast(df) if n <= max_bytes else df
