"""Divergence of sources: how unlike the term counts of the sources of a language are.

Terms are counted by (language, source) in the tasks that read the texts and summed. A
language keeps the terms that enough of its documents hold. The kept terms get ids
(bucket, slot): buckets of about BLOCK terms by the term's hash. For every source,
bucket and count level one bitset says which terms have that count; the terms without
occurrences are the complement. For two sources, the AND of two levels and its popcount
give the number of terms in that joint cell, which is multiplied by the cell's
difference; the sum over all cells and buckets is the pair's divergence.

A bucket's bitsets of up to SOURCES sources lie in one task; more sources are dealt in
blocks that meet pairwise, so no group holds more than two blocks of a bucket. What
reaches the driver are two numbers (the largest vocabulary and the most sources of a
language).

Defined cases: NULL text, lang and source are ''; a text without terms makes its group
known and adds nothing; a language without kept terms has divergence 0 between all its
sources; very long texts are counted whole; ties are ranked by the name's UTF-8 bytes;
repeated rows and repeated or NULL doc_ids count each; an empty table gives no rows;
extra columns of any name are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import ship, written

MIN_DOCS = 30
SMOOTHING = 5
WHOLE = 1_000_000_000
TOP_TERMS = 50
BLOCK = 256        # kept terms in a bucket, about
SOURCES = 64       # sources whose bitsets meet in one task
FLUSH = 200_000    # terms held in a task before they are handed on

# Letters A-Z become small, other ASCII characters end a term; the rest belongs to it.
_TERM_BYTES = bytes(c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A
                    else 0x20 for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return raw.translate(_TERM_BYTES).split()


def _count_terms(batches):
    """(lang, source, term, n, docs) partial sums; a row without term names a group."""
    held, size = {}, 0

    def handed_on():
        for (lang, source), (n, docs) in held.items():
            words = list(n)
            k = len(words) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()),
                 pa.array([None, *words], pa.binary()).cast(pa.string()),
                 pa.array([0, *(n[w] for w in words)], pa.int64()),
                 pa.array([0, *(docs[w] for w in words)], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = batch.column(2).cast(pa.binary())
        for lang, source, text in zip(langs, sources, texts):
            once = Counter(terms(text.as_py()))
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            n.update(once)
            docs.update(once.keys())
            size += len(n) - before
            if size >= FLUSH:
                yield from handed_on()
                held, size = {}, 0
    yield from handed_on()


def _share(count: str, total: str, terms_kept: str) -> str:
    """SQL: 1 + floor(WHOLE * (count + SMOOTHING) / (total + SMOOTHING * terms)), exactly."""
    return (f"1L + CAST({WHOLE} AS DECIMAL(10,0)) * CAST({count} + {SMOOTHING}L AS DECIMAL(20,0))"
            f" div CAST({total} + {SMOOTHING}L * {terms_kept} AS DECIMAL(20,0))")


def _joint(key, rows):
    """Summed differences of the pairs of sources that meet in one bucket."""
    size = int(rows["size"].iloc[0])
    width = -(-size // 64)
    full = np.packbits(np.arange(width * 64) < size, bitorder="little").view(np.uint64)
    maps, shares = [], []
    for zero, level, share, word, bits in zip(rows["zero"], rows["level"], rows["share"],
                                              rows["word"], rows["bits"]):
        if level is None or not len(level):
            maps.append(full[None, :])
            shares.append(np.array([zero]))
            continue
        _, first, at = np.unique(level, return_index=True, return_inverse=True)
        table = np.zeros((len(first) + 1, width), np.uint64)
        table[at + 1, np.asarray(word)] = np.asarray(bits, np.int64).view(np.uint64)
        table[0] = full & ~np.bitwise_or.reduce(table[1:], axis=0)
        maps.append(table)
        shares.append(np.concatenate(([zero], np.asarray(share)[first])))
    sources, own, blocks = rows["source"].tolist(), rows["own"].tolist(), key[2:]
    out = []
    for a in range(len(sources)):
        for b in range(a):
            if blocks[0] != blocks[1] and own[a] == own[b]:
                continue  # these two meet in the block of their own
            cells = np.bitwise_count(maps[a][:, None, :] & maps[b][None, :, :]).sum(
                axis=-1, dtype=np.int64)
            f = np.abs(shares[a][:, None] - shares[b][None, :])
            x, y = sorted((sources[a], sources[b]))
            out.append((key[0], x, y, int((cells * f).sum())))
    return pd.DataFrame(out, columns=["lang", "x", "y", "value"])


class Audit:
    """Counts, kept terms and groups of a documents table, written once."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK,
                 sources: int = SOURCES):
        ship(docs.sparkSession)
        blank = F.lit("")
        texts = docs.select(*[F.coalesce(c, blank).alias(c) for c in ("lang", "source", "text")])
        parts = texts.mapInArrow(_count_terms,
                                 "lang string, source string, term string, n long, docs long")
        counts = written(parts.groupBy("lang", "source", "term").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
        kept = written(counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
            F.sum("docs").alias("docs"), F.sum("n").alias("total"))
            .where(F.col("docs") >= min_docs), "divergence-kept")
        langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
        buckets = -(-(langs.agg(F.max("v")).first()[0] or 1) // block)
        place = Window.partitionBy("lang", "bucket")
        slots = (kept.withColumn("bucket", F.expr(f"pmod(xxhash64(term), {buckets}L)"))
                 .withColumn("slot", F.row_number().over(place.orderBy("term")) - 1)
                 .select("lang", "term", "total", "bucket", "slot"))
        cells = written(counts.where("term IS NOT NULL").select("lang", "source", "term", "n")
                        .join(slots, ["lang", "term"]), "divergence-cells")
        sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
        self.groups = written(
            counts.select("lang", "source").distinct().join(langs, "lang", "left")
            .join(sums, ["lang", "source"], "left")
            .na.fill(0, ["v", "lang_n", "group_n"]), "divergence-groups")
        most = self.groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
        self.source_blocks = -(-most // sources)
        # every cell has its group: the join finds the share of its count
        self.cells = (cells.join(self.groups, ["lang", "source"])
                      .withColumn("share", F.expr(_share("n", "group_n", "v"))))

    def bitmaps(self) -> DataFrame:
        """lang, bucket, source and its bitsets: lists of level (count), share, word, bits."""
        words = self.cells.groupBy("lang", "bucket", "source", "n", "share",
                                   F.expr("slot div 64").cast("int").alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, slot % 64))").alias("bits"))
        entry = F.struct("n", "share", "word", "bits")
        return words.groupBy("lang", "bucket", "source").agg(
            F.collect_list(entry).alias("e")).select(
            "lang", "bucket", "source", F.col("e.n").alias("level"),
            F.col("e.share").alias("share"), F.col("e.word").alias("word"),
            F.col("e.bits").alias("bits"))

    def pairs(self) -> DataFrame:
        """lang, source, item, value for every ordered pair of sources of a language."""
        sizes = self.cells.select("lang", "bucket", "term").distinct().groupBy(
            "lang", "bucket").agg(F.count("*").alias("size"))
        # a bucket of no terms lets every pair of sources meet at least once
        sizes = sizes.unionByName(self.groups.select("lang").distinct().select(
            "lang", F.lit(-1).cast("long").alias("bucket"),
            F.lit(0).cast("long").alias("size")))
        zero = F.expr(f"CASE WHEN v > 0 THEN {_share('0L', 'group_n', 'v')} ELSE 0L END")
        n = self.source_blocks
        placed = (self.groups.select("lang", "source", zero.alias("zero"))
                  .withColumn("own", F.expr(f"pmod(xxhash64(source), {n}L)"))
                  .withColumn("other", F.explode(F.expr(f"sequence(0L, {n - 1}L)"))))
        dealt = (placed.join(sizes, "lang")
                 .join(written(self.bitmaps(), "divergence-bitmaps"),
                       ["lang", "bucket", "source"], "left")
                 .withColumn("i", F.least("own", "other"))
                 .withColumn("j", F.greatest("own", "other")))
        found = dealt.groupBy("lang", "bucket", "i", "j").applyInPandas(
            _joint, "lang string, x string, y string, value long")
        summed = written(found.groupBy("lang", "x", "y").agg(F.sum("value").alias("value")),
                         "divergence-pairs")
        return summed.select("lang", F.col("x").alias("source"), F.col("y").alias("item"),
                             "value").union(summed.select("lang", "y", "x", "value"))

    def telling_terms(self) -> DataFrame:
        """lang, source, item, value of the terms with a greater share than in the language."""
        q = F.expr(_share("total", "lang_n", "v"))
        return (self.cells.withColumn("q", q).where("share > q")
                .select("lang", "source", F.col("term").alias("item"),
                        (F.col("share") - F.col("q")).alias("value")))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
          block: int = BLOCK, sources: int = SOURCES) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    found = Audit(docs, min_docs, block, sources)
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(df, part):
        return df.withColumn("rank", F.row_number().over(group)).select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return ranked(found.pairs(), "pair").union(
        ranked(found.telling_terms(), "term").where(F.col("rank") <= top))
