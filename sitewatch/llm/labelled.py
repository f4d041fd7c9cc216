"""Bounded samples of documents for fitting a model on the driver.

A sample is the share of the rows whose hash lies under a limit set from the number
of rows, so that about the wanted number is sent to the driver however many rows or
partitions there are, and reruns draw the same rows. Rows that repeat are one row of
the sample: a group of copies can't swell it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARES = 1 << 30


def _under_share(hash_column, share: float):
    """Rows of about the given share, by hash; all of them from a share of 1 on."""
    return F.pmod(hash_column, F.lit(SHARES)) < int(min(1.0, share) * SHARES)


def text_sample(docs: DataFrame, rows: int, max_bytes: int) -> list[str]:
    """About ``rows`` (at most) different texts of at most ``max_bytes`` bytes, whole."""
    total = docs.count()
    drawn = (docs.where(F.octet_length("text") <= max_bytes)
             .select(F.xxhash64("text").alias("h"), "text")
             .where(_under_share(F.col("h"), 1.1 * rows / max(1, total)))
             .groupBy("h").agg(F.min("text").alias("text")))
    found = sorted(drawn.collect(), key=lambda r: r["h"] % SHARES)
    return [r["text"] for r in found[:rows]]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int,
                    usable=None) -> list[tuple[int, str, int]]:
    """About ``rows`` (at most) of (doc_id, text, label), ordered by doc_id.

    Only texts of at most ``max_bytes`` bytes are fitted on, so the sample is bounded
    by rows * max_bytes, however the tables grow. A doc_id with contradicting labels,
    a NULL label or a NULL text is left out; repeated rows count once. ``usable`` is
    a further condition on doc_id. The documents are only filtered, by the drawn ids
    (about 1.5 * rows of them), which are broadcast.
    """
    one = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
           .select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("_label")))
    if usable is not None:
        one = one.where(usable)
    h = F.xxhash64("doc_id")
    # more ids than rows: texts that are too long leave gaps
    total = one.select("doc_id").distinct().count()
    drawn = one.where(_under_share(h, 1.5 * rows / max(1, total)))
    ids = (drawn.groupBy("doc_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_hi"))
           .where("_label = _hi").drop("_hi"))
    texts = docs.select(F.col("doc_id").cast("long"), "text").where(
        F.octet_length("text") <= max_bytes)
    found = (texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "_label")
             .agg(F.min("text").alias("text"), F.min(h).alias("h")).collect())
    kept = sorted(found, key=lambda r: r["h"] % SHARES)[:rows]
    return [(r["doc_id"], r["text"], r["_label"])
            for r in sorted(kept, key=lambda r: r["doc_id"])]
