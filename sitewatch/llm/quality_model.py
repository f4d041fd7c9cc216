"""Quality classifier: supervised subword embeddings, averaged per document.

A document's features are hashed words, hashed pairs of neighbouring words and hashed
character n-grams inside words. Every feature has a learned vector; each of the three kinds
is averaged over the whole text, the means are averaged and a softmax over the two labels
follows. Trained by stochastic gradient descent in numpy on a bounded sample of labelled
rows (SAMPLE_ROWS texts of at most SAMPLE_BYTES bytes); every document is then scored
whole. As the softmax is linear in the average, each feature's vector is folded to one
number before scoring.

Defined cases: NULL or empty text scores the learned prior; very long texts are scored
whole, in chunks; without two labels in the sample every score is the share of label 1 (0.5
without any); repeated rows are all returned; an empty table gives no rows; extra columns
of any name are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import crc_bucket, ship
from sitewatch.llm.labelled import labelled_sample

SAMPLE_ROWS = 4000
SAMPLE_BYTES = 16384
BUCKET_BITS = 18
DIM = 12
GRAMS = (3, 4, 5)
EPOCHS = 4
RATE = 0.6
CUTOFF = 0.3
HELD_OUT_OF = 5
KINDS = 3
CHUNK = 1 << 20  # bytes featurized at once, cut between words

PAIRS = np.uint32(1 << BUCKET_BITS)  # pairs have buckets of their own
ROWS = 2 << BUCKET_BITS

_MULT = np.uint32(0x01000193)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(64, 0x100000001B3, dtype=np.uint64))


def _bucket(h: np.ndarray) -> np.ndarray:
    """The upper bits of a multiplicative hash of 32-bit values."""
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def _chunks(raw: bytes):
    """Whole words of ``raw``, single-spaced with a space at both ends, in chunks."""
    at = 0
    while at < len(raw):
        end = at + CHUNK
        if end < len(raw):
            cut = max(raw.rfind(s, at, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            while cut <= at and end < len(raw):  # a word longer than the chunk
                end += CHUNK
                cut = max(raw.rfind(s, at, end)
                          for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            end = cut if cut > at else len(raw)
        words = raw[at:end].split()
        if words:
            yield b" " + b" ".join(words) + b" "
        at = end


def features(raw: bytes):
    """Per chunk: buckets of words, of pairs of neighbours and of n-grams."""
    before = np.empty(0, np.uint64)
    for text in _chunks(raw):
        b = np.frombuffer(text, dtype=np.uint8)
        space = b == 32
        spaces = np.flatnonzero(space)
        starts, ends = spaces[:-1] + 1, spaces[1:]
        inner = np.flatnonzero(~space)
        first = np.repeat(starts, ends - starts)
        terms = (b[inner].astype(np.uint64) + np.uint64(1)) * _POWERS[(inner - first) & 63]
        heads = np.concatenate(([0], np.cumsum(ends - starts)[:-1]))
        words = np.add.reduceat(terms, heads)
        words ^= words >> np.uint64(32)
        both = np.concatenate((before, words))
        pairs = both[:-1] * _PAIR ^ both[1:]
        pairs ^= pairs >> np.uint64(32)
        before = words[-1:]
        grams = []
        h = b.astype(np.uint32)
        for n in range(2, max(GRAMS) + 1):
            h = h[:-1] * _MULT + b[n - 1:]
            if n not in GRAMS or not len(h):
                continue
            inside = np.ones(len(h), dtype=bool)
            for j in range(1, n - 1):  # a space may only be the first or the last byte
                inside &= ~space[j:len(b) - n + 1 + j]
            grams.append(_bucket(h[inside] + np.uint32(n)))
        yield (_bucket(words.astype(np.uint32)), _bucket(pairs.astype(np.uint32)) + PAIRS,
               np.concatenate(grams) if grams else np.empty(0, np.uint32))


def _counted(raw: bytes):
    """(ids, weights) of a document's mean over the kinds of features it has."""
    kinds = [np.concatenate(k) for k in zip(*features(raw))]
    kinds = [k for k in kinds if len(k)]
    if not kinds:
        return np.empty(0, np.int64), np.empty(0)
    weights = np.concatenate([np.full(len(k), 1 / len(k)) for k in kinds]) / KINDS
    ids, back = np.unique(np.concatenate(kinds).astype(np.int64), return_inverse=True)
    return ids, np.bincount(back, weights)


def fit(sample: list[tuple[int, str, int]], seed: int = 7):
    """Folded weight per bucket (float32) and the bias."""
    labels = np.array([y for _, _, y in sample], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        share = labels.mean() if len(labels) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return np.zeros(ROWS, np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (ROWS, DIM)).astype(np.float32) / DIM
    out = np.zeros((DIM, 2), dtype=np.float32)
    bias = np.log(np.bincount(labels, minlength=2) / len(labels)).astype(np.float32)
    steps, step = EPOCHS * len(sample), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(sample)):
            rate = RATE * (1 - step / steps)
            step += 1
            ids, weights = _counted(sample[i][1].encode())
            rows = vectors[ids]
            mean = weights.astype(np.float32) @ rows if len(ids) else np.zeros(DIM, np.float32)
            score = mean @ out + bias
            p = np.exp(score - score.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= 0.1 * rate * p
            if len(ids):
                # few features carry most of the mean: scale each one's step by its weight
                vectors[ids] = rows - rate * 30 * weights[:, None].astype(np.float32) * back
    return (vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def logit(raw: bytes, folded: np.ndarray, bias: float) -> float:
    total, n = np.zeros(KINDS), np.zeros(KINDS)
    for kinds in features(raw):
        total += [folded[k].sum(dtype=np.float64) for k in kinds]
        n += [len(k) for k in kinds]
    return bias + float((total / np.maximum(1, n)).sum() / KINDS)


def score_udf(spark, folded: np.ndarray, bias: float):
    shared = spark.sparkContext.broadcast((folded, bias))  # ROWS floats

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        f, b = shared.value
        logits = np.array([logit(t or b"", f, b) for t in text.cast(pa.binary()).to_pylist()])
        return pa.array(1 / (1 + np.exp(-np.clip(logits, -500, 500))))
    return score


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; fitted on rows that are not held out."""
    ship(docs.sparkSession)
    held_out = crc_bucket(F.col("doc_id"), HELD_OUT_OF) == 0
    sample = labelled_sample(docs, labels.where(F.col("quality").isin(0, 1)), "quality",
                             SAMPLE_ROWS, SAMPLE_BYTES, ~held_out)
    score = score_udf(docs.sparkSession, *fit(sample))
    return (docs.select("doc_id", held_out.alias("held_out"),
                        score(F.coalesce("text", F.lit(""))).alias("score"))
            .withColumn("predicted", (F.col("score") >= CUTOFF).cast("int")))
