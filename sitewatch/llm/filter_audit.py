"""Audit of five text filters: what each one removes, in every order of application.

Four filters are told from a document alone (few words, repeated words, capitals,
symbols). The fifth, E, removes exact copies and is an existential self-join: a left
semi-join on the text's hash, the exact text and a smaller doc_id marks the copies. Its
ids are united with the other failures, each row's failures make one combination of
five bits, and the documents of a part are counted by combination: 32 counts tell the
outcome of all 120 orders.

Only texts whose hash occurs twice or more are compared, and the other side of the
semi-join holds one row per such text (its smallest doc_id, partial minima first), so
that a text with very many copies meets one row. Both sides are written before, so that
the engine knows their sizes, broadcasts a small one and splits a hot hash otherwise.

Defined cases: NULL text is empty, NULL lang is the part ''; an empty text has no words,
fails A only, or E too; a copy is one whatever its length; rows with one doc_id and one
text are no copies of each other; a NULL doc_id neither is nor makes a copy and has no
label; repeated rows count each; labels of one doc_id count as set if any row sets them;
an empty table has no parts and gives no rows; extra columns of any name are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import WS, written

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80      # per cent of the words
MAX_CAPITALS = 10      # per cent of the code points
SYMBOLS = "[#$%&*|]"
COPY = 1 << FILTERS.index("E")


def own_failures(text: str = "_text") -> str:
    """SQL: bits of the filters A to D that a text fails, its words in ``_words``."""
    tests = [f"size(_words) < {MIN_WORDS}",
             f"100L * size(array_distinct(_words)) < {MIN_DISTINCT}L * size(_words)",
             f"100L * length(regexp_replace({text}, '[^A-Z]+', '')) "
             f"> {MAX_CAPITALS}L * length({text})",
             f"{text} RLIKE '{SYMBOLS}'"]
    return " + ".join(f"IF({t}, {1 << i}, 0)" for i, t in enumerate(tests))


def _rows(docs: DataFrame) -> DataFrame:
    """uid, doc_id, part, bits and, for texts whose hash others share, hash and copied text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("lang", F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("_text"))
    hashes = texts.select(F.xxhash64("_text").alias("hash")).groupBy("hash").count()
    shared = written(hashes.where("count > 1").select(F.col("hash").alias("shared")),
                     "audit-hashes")
    read = texts.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "part",
        F.xxhash64("_text").alias("hash"), "_text",
        F.array_remove(F.split("_text", f"[{WS}]+"), "").alias("_words"))
    judged = read.select("uid", "doc_id", "part", "hash", "_text",
                         F.expr(own_failures()).alias("bits"))
    return written(judged.join(shared, F.col("hash") == F.col("shared"), "left").select(
        "uid", "doc_id", "part", "bits", F.col("shared").alias("hash"),
        F.expr("IF(shared IS NULL, NULL, _text)").alias("copied")), "audit-rows")


def copies(rows: DataFrame) -> DataFrame:
    """The rows whose text some smaller doc_id has (left semi-join)."""
    shared = rows.where("hash IS NOT NULL")
    first = written(shared.groupBy("hash", "copied").agg(F.min("doc_id").alias("first")),
                    "audit-first")
    r, f = shared.alias("r"), first.alias("f")
    return r.join(f, F.expr("r.hash = f.hash AND r.copied = f.copied AND f.first < r.doc_id"),
                  "left_semi")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, n, good, toxic: the documents of each combination of failures."""
    rows = _rows(docs)
    own = rows.select("uid", "part", "doc_id", "bits")
    failed = own.unionByName(copies(rows).select("uid", "part", "doc_id",
                                                 F.lit(COPY).alias("bits")))
    each = failed.groupBy("uid", "part", "doc_id").agg(F.bit_or("bits").alias("bits"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("IF(quality = 1, 1L, 0L)")).alias("good"),
        F.max(F.expr("IF(toxic = 1, 1L, 0L)")).alias("toxic"))
    return each.join(marks, "doc_id", "left").groupBy("part", "bits").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def outcomes(counts: DataFrame) -> DataFrame:
    """One row per part, filter order and step from :func:`combinations`."""
    orders = ", ".join(f"'{''.join(p)}'" for p in permutations(FILTERS))
    fails = " || ".join(f"IF(bits & {1 << i} > 0, '{c}', '')" for i, c in enumerate(FILTERS))
    steps = (counts.withColumn("_fails", F.expr(fails))
             .withColumn("filter_order", F.explode(F.expr(f"array({orders})")))
             .withColumn("step", F.explode(F.expr(f"sequence(1, {len(FILTERS)})")))
             .withColumn("_own", F.expr("substring(filter_order, step, 1)"))
             .withColumn("_here", F.expr("contains(_fails, _own)"))
             .withColumn("_gone", F.expr(
                 "translate(_fails, substring(filter_order, 1, step - 1), '') <> _fails")))

    def counted(test: str, column: str = "n"):
        return F.sum(F.expr(f"IF({test}, {column}, 0L)"))

    out = steps.groupBy("part", "filter_order", "step", "_own").agg(
        counted("NOT _gone AND NOT _here").alias("kept"),
        counted("_here AND NOT _gone").alias("removed"),
        counted("_here AND _gone").alias("redundant"),
        counted("_fails = _own").alias("unique_fails"),
        counted("_here AND NOT _gone", "good").alias("good_lost"),
        counted("_here AND NOT _gone", "toxic").alias("toxic_lost"))
    whole = Window.partitionBy("part", "_own")  # 120 rows
    return out.withColumn("shapley", F.sum("removed").over(whole)).drop("_own")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of every step of every order."""
    return outcomes(written(combinations(docs, labels), "audit-counts"))
