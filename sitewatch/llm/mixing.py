"""Mixing sources to target weights by nested hash thresholds.

Each source gets whole passes over its documents plus one part pass: the documents
whose hash lies under a threshold. The threshold comes from histograms of words by
(source, hash bucket): the bucket that the remaining budget ends in is found, and
only its documents are counted again by the next 12 hash bits, until a bucket holds
one hash value. Nothing is sorted but at most 4096 buckets per source, and the rows
are only filtered. Reruns agree: the hash is a digest of the doc_id.

Defined cases: NULL text has size 0; NULL source is a source of its own, ordered
last; NULL doc_id hashes like the empty text; rows that repeat a doc_id are taken or
left together; extra columns pass through ``mixed_documents``; an empty table gives
no rows. A source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import WS, written

WEIGHTS = (5, 2, 1)   # repeating, over the sources in code-point order
MOST = 3              # a source is used at most this many times
HASH_BITS, STEP = 60, 12


def doc_hash(col):
    """60 bits of the MD5 digest of the id as text."""
    text = F.coalesce(col.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def n_words(col: str):
    pattern = f"[{WS}]+".replace("\\", "\\\\")
    return F.expr(f"cast(size(array_remove(split(coalesce({col}, ''), '{pattern}'), '')) as long)")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target: one row per source.

    A source's share of all words goes by its weight; what exceeds MOST times its
    size is shared again by weight. The level at which that ends is found in one
    running sum over the sources, ordered by size for weight.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(w) for w in WEIGHTS])
    t = total.withColumn("_w", F.get(weight, (F.row_number().over(order) - 1) % len(WEIGHTS))
                         .cast("long"))
    t = t.withColumn("_most", MOST * F.col("source_size"))
    run = Window.orderBy(F.col("_most") / F.col("_w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    t = (t.withColumn("_capped", F.coalesce(
            F.sum("_most").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("_open", F.sum("_w").over(run.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("_rank", F.row_number().over(run))
         .withColumn("_all", F.sum("source_size").over(every)))
    t = t.withColumn("_level", (F.col("_all") - F.col("_capped")) / F.col("_open"))
    t = t.withColumn("_fits", F.col("_most") > F.col("_w") * F.col("_level"))
    t = t.withColumn("_final", F.min_by("_level", F.when(F.col("_fits"), F.col("_rank")))
                     .over(every))
    t = t.withColumn("_first", F.min(F.when(F.col("_fits"), F.col("_rank"))).over(every))
    return t.select("source", "source_size", F.when(
        F.col("_rank") >= F.col("_first"), F.col("_w") * F.col("_final"))
        .otherwise(F.col("_most").cast("double")).alias("target"))


def _same(a, b):
    return a.eqNullSafe(b)


def thresholds(sizes: DataFrame) -> DataFrame:
    """One row per source: source_size, target, whole passes and the part pass's limit.

    The part pass takes the hashes under ``limit`` and, if ``at_limit``, those equal
    to it: the hash value in which the budget ends is taken if half of it fits.
    """
    plan = targets(sizes)
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = (plan.withColumn("whole", F.least(whole.cast("long"), F.lit(MOST).cast("long")))
            .withColumn("part", F.greatest(
                F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))))
    plan = written(plan, "mixing-targets")
    state = plan.select("source", "part", F.lit(0).cast("long").alias("prefix"),
                        F.lit(0).cast("long").alias("below")).where("part > 0")
    inside, level = sizes.where("size > 0"), 0
    while True:
        level += STEP
        shift = HASH_BITS - level
        at = inside.withColumn("_bucket", F.shiftright("hash", shift))
        seen = at.groupBy("source", "_bucket").agg(
            F.sum("size").alias("_sum"), F.min("hash").alias("_lo"), F.max("hash").alias("_hi"))
        st = state.withColumnRenamed("source", "_source")
        run = Window.partitionBy("source").orderBy("_bucket")
        upto = (seen.join(st, _same(F.col("source"), F.col("_source"))).drop("_source")
                .withColumn("_upto", F.col("below") + F.sum("_sum").over(run)))
        # the bucket in which the budget ends: the first whose running sum reaches it
        rank = Window.partitionBy("source").orderBy("_bucket")
        found = (upto.where(F.col("_upto") >= F.col("part"))
                 .withColumn("_r", F.row_number().over(rank)).where("_r = 1")
                 .select("source", "part", F.col("_bucket").alias("prefix"),
                         (F.col("_upto") - F.col("_sum")).alias("below"),
                         F.col("_sum").alias("held"), "_lo", "_hi"))
        found = written(found, "mixing-level")
        if shift == 0 or found.where("_lo < _hi").isEmpty():
            break
        state = found.select("source", "part", "prefix", "below")
        edge = found.select(F.col("source").alias("_source"), F.col("prefix").alias("_prefix"))
        inside = written(at.join(edge, _same(F.col("source"), F.col("_source"))
                                 & (F.col("_bucket") == F.col("_prefix")))
                         .select("source", "hash", "size"), "mixing-edge")
    ends = found.select(F.col("source").alias("_source"), F.col("_lo").alias("limit"),
                        (F.col("part") - F.col("below") >= F.col("held") / 2).alias("at_limit"))
    # one row per source, written: its size is known to whoever joins it
    return written(plan.join(ends, _same(F.col("source"), F.col("_source")), "left")
                   .drop("_source"), "mixing-thresholds")


def _planned(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds source_size, target and copies (passes that take the row) to every row."""
    p = plan.withColumnRenamed("source", "_source")
    extra = F.coalesce((F.col("hash") < F.col("limit"))
                       | ((F.col("hash") == F.col("limit")) & F.col("at_limit")), F.lit(False))
    return (sizes.join(p, _same(F.col("source"), F.col("_source")))
            .withColumn("copies", F.col("whole") + extra.cast("long")))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: one row per document."""
    sizes = written(docs.select("doc_id", "source", n_words("text").alias("size"),
                                doc_hash(F.col("doc_id")).alias("hash")), "mixing-sizes")
    return (_planned(sizes, thresholds(sizes))
            .withColumn("taken", F.col("size") * F.col("copies"))
            .select("doc_id", "source", "size", "source_size", "target", "taken", "copies"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it (columns unchanged)."""
    sizes = written(docs.select("source", n_words("text").alias("size"),
                                doc_hash(F.col("doc_id")).alias("hash")), "mixing-sizes")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    carried = docs.select("source", doc_hash(F.col("doc_id")).alias("hash"), row)
    rows = _planned(carried, thresholds(sizes)).where("copies > 0")
    rows = rows.select("row", F.explode(F.expr("sequence(1L, copies)")).alias("_turn"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
