"""Toxicity severity: cumulative-link ordinal regression on sparse text features.

Features are the words of a text (runs of letters, lower case) and the first 3 to 7
letters of longer words, each with log(1 + count); those that tell the labels apart
best (chi-square over the sample) are kept. One weight vector is shared by the ordered
thresholds of P(grade > k) = sigmoid(w x - theta_k); the output is the expected grade.

The labels only say toxic or not. Grade 0 is not toxic; toxic documents of the sample
are graded 1 to 3 by tertiles of how often they use the kept features that are far
commoner in toxic documents. The sample is bounded (SAMPLE_ROWS texts of at most
SAMPLE_BYTES bytes); every document is scored whole.

Defined cases: NULL or empty text has no features; without both labels in the sample
every severity is 0; repeated rows are all returned; extra columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import ship
from sitewatch.llm.labelled import labelled_sample

SAMPLE_ROWS = 8000
SAMPLE_BYTES = 16384
GRADES = 4
KEPT = 3000          # features
MIN_DOCS = 4         # toxic documents that a feature must be in
MIN_CHI = 20.0       # least chi-square: weaker features are noise
STEMS = range(3, 8)  # letters of a word's beginnings
RIDGE = 1e-4
MEMORY_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def names(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings marked with ^."""
    return [word] + ["^" + word[:n] for n in STEMS if n < len(word)]


class Vocabulary(dict):
    """word -> indices of its kept features, worked out when first met."""

    def __init__(self, kept: dict[str, int]):
        super().__init__()
        self.kept = kept

    def __missing__(self, word):
        if len(self) > MEMORY_WORDS:
            self.clear()
        found = self[word] = tuple(self.kept[n] for n in names(word) if n in self.kept)
        return found

    def counts(self, text: str) -> Counter:
        found: Counter = Counter()
        for word in _WORD.findall(text.lower()):
            if ids := self[word]:
                found.update(ids)
        return found


def choose(texts: list[str], toxic: np.ndarray):
    """Kept features, and which of them are far commoner in toxic documents."""
    def present(text):
        return {n for w in set(_WORD.findall(text.lower())) for n in names(w)}

    seen_toxic: Counter = Counter()
    for text, y in zip(texts, toxic):
        if y:
            seen_toxic.update(present(text))
    frequent = {name for name, a in seen_toxic.items() if a >= MIN_DOCS}
    seen: Counter = Counter()
    for text in texts:
        seen.update(frequent & present(text))
    n, n1 = len(texts), int(toxic.sum())
    rated = []
    for name, df in seen.items():
        a = seen_toxic[name]
        if a * n <= df * n1:  # keep what speaks for the toxic label
            continue
        b, c = df - a, n1 - a
        d = n - df - c
        chi = n * (a * d - b * c) ** 2 / max(1.0, float(df) * (n - df) * n1 * (n - n1))
        if chi >= MIN_CHI:
            rated.append((-chi, name, a, df))
    rated.sort()
    kept = {name: i for i, (_, name, _, _) in enumerate(rated[:KEPT])}
    telling = np.array([a / df > 0.8 for _, _, a, df in rated[:KEPT]], dtype=bool)
    return kept, telling


def _rows(vocabulary: Vocabulary, texts):
    """Sparse rows: row numbers, feature indices, values log(1 + count)."""
    row, col, val = [], [], []
    for i, text in enumerate(texts):
        for j, c in vocabulary.counts(text).items():
            row.append(i)
            col.append(j)
            val.append(np.log1p(c))
    return np.array(row, np.int64), np.array(col, np.int64), np.array(val)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(sample: list[tuple[int, str, int]], rounds: int = 1500):
    """(kept features, shared weights, thresholds, cutoff of P(grade > 0)).

    The cutoff has the best F1 on the sample, in the middle of the gap where it ties.
    Thresholds are None without both labels.
    """
    texts = [t for _, t, _ in sample]
    toxic = np.array([y for _, _, y in sample], dtype=np.int64) == 1
    if toxic.all() or not toxic.any():
        return {}, np.zeros(0), None, 1.0
    kept, telling = choose(texts, toxic)
    row, col, val = _rows(Vocabulary(kept), texts)
    use = np.bincount(row, weights=np.expm1(val) * telling[col] if len(col) else None,
                      minlength=len(texts))
    grade = np.zeros(len(texts), dtype=np.int64)
    cuts = np.quantile(use[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
    grade[toxic] = 1 + np.searchsorted(cuts, use[toxic], side="left")
    w = np.zeros(len(kept))
    share = np.array([(grade > k).mean() for k in range(GRADES - 1)]).clip(1e-4, 1 - 1e-4)
    theta = np.log((1 - share) / share)
    above = grade[:, None] > np.arange(GRADES - 1)
    m = {"w": np.zeros_like(w), "t": np.zeros_like(theta)}
    v = {"w": np.zeros_like(w), "t": np.zeros_like(theta)}
    for step in range(1, rounds + 1):
        x = np.bincount(row, weights=val * w[col], minlength=len(texts))
        # gradient of the sum over thresholds of the log loss of P(grade > k)
        err = (_sigmoid(x[:, None] - theta) - above) / len(texts)
        grads = {"w": np.bincount(col, weights=val * err.sum(axis=1)[row], minlength=len(w))
                 + RIDGE * w, "t": -err.sum(axis=0)}
        for name, p in (("w", w), ("t", theta)):
            m[name] = 0.9 * m[name] + 0.1 * grads[name]
            v[name] = 0.999 * v[name] + 0.001 * grads[name] ** 2
            p -= 0.05 * (m[name] / (1 - 0.9 ** step)) / (
                np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)
        theta.sort()
    p = _sigmoid(np.bincount(row, weights=val * w[col], minlength=len(texts)) - theta[0])
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + toxic.sum())
    f1[np.flatnonzero(p[order][1:] == p[order][:-1])] = 0  # no cut between equal scores
    best = int(np.argmax(f1))
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return kept, w, theta, float((p[order][best] + below) / 2)


def severity_udf(spark, kept, w, theta):
    shared = spark.sparkContext.broadcast((kept, w, theta))  # at most KEPT features
    memory: dict = {}

    @F.arrow_udf("array<double>")
    def above(text: pa.Array) -> pa.Array:
        kept, w, theta = shared.value
        if "v" not in memory:
            memory["v"] = Vocabulary(kept)
        v, out = memory["v"], []
        for t in text.to_pylist():
            x = sum(w[j] * np.log1p(c) for j, c in v.counts(t or "").items())
            out.append([0.0] * (GRADES - 1) if theta is None else _sigmoid(x - theta).tolist())
        return pa.array(out, pa.list_(pa.float64()))
    return above


def severities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, severity (expected grade, 0 to 3), grade (most probable), toxic (0 or 1)."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels.where(F.col("toxic").isin(0, 1)), "toxic",
                             SAMPLE_ROWS, SAMPLE_BYTES)
    *model, cutoff = fit(sample)
    above = severity_udf(docs.sparkSession, *model)
    scored = docs.select("doc_id", above(F.coalesce("text", F.lit(""))).alias("p"))
    p = [F.lit(1.0), *[F.col("p")[k] for k in range(GRADES - 1)], F.lit(0.0)]
    mass = F.array(*[p[k] - p[k + 1] for k in range(GRADES)])
    return scored.select(
        "doc_id", sum(p[1:GRADES]).alias("severity"),
        (F.array_position(mass, F.array_max(mass)) - 1).cast("int").alias("grade"),
        (p[1] >= cutoff).cast("int").alias("toxic"))
