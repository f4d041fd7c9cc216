"""Quality and toxicity models: held-out accuracy, gradients, edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewatch.llm import labelled, quality_model as Q, toxicity as T

from .helpers import EDGES, clashing

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{MID}/documents.parquet"),
            spark.read.parquet(f"{MID}/labels.parquet"))


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    rows = Q.quality_scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held) > 50
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_quality_learns_only_from_the_other_rows(tables):
    docs, labels = tables
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(
        F.col("quality")))
    a, b = ({r.doc_id: r.score for r in Q.quality_scores(docs, x).collect()}
            for x in (labels, turned))
    assert a == b


def test_quality_inputs_are_the_text_alone(tables):
    docs, labels = tables
    odd = docs.selectExpr("doc_id", "text", "'zz' AS lang", "NULL AS source", "0L AS n_chars")
    a, b = ({r.doc_id: r.score for r in Q.quality_scores(d, labels).collect()}
            for d in (docs, odd))
    assert a == b


def plain_logit(text, folded, bias):
    """The score by its definition: words, pairs of words and n-grams one at a time."""
    def bucket(h):
        return (h * 0x9E3779B1 % 2**32) >> (32 - Q.BUCKET_BITS)

    words = []
    for w in text.encode().split():
        h = sum((b + 1) * pow(0x100000001B3, (i & 63) + 1, 2**64) for i, b in enumerate(w)) % 2**64
        words.append(h ^ (h >> 32))
    kinds = [[bucket(w % 2**32) for w in words], [], []]
    for a, b in zip(words, words[1:]):
        h = (a * 0x9E3779B97F4A7C15 % 2**64) ^ b
        kinds[1].append(bucket((h ^ (h >> 32)) % 2**32) + (1 << Q.BUCKET_BITS))
    spaced = b" " + b" ".join(text.encode().split()) + b" "
    for n in Q.GRAMS:
        for i in range(len(spaced) - n + 1):
            gram = spaced[i:i + n]
            if b" " not in gram[1:-1]:
                h = 0
                for byte in gram:
                    h = (h * 0x01000193 + byte) % 2**32
                kinds[2].append(bucket((h + n) % 2**32))
    return bias + sum(np.mean([float(folded[i]) for i in k]) for k in kinds if k) / 3


def test_score_equals_the_plain_form():
    folded = np.random.default_rng(3).normal(size=Q.ROWS).astype(np.float32)
    for text in ("", " \n", "one", "two words", "Ünï word word  x\n\ty " * 50 + "z" * 500 + " end",
                 "a bb a bb \x0b\x0c tail"):
        assert Q.logit(text.encode(), folded, 0.1) == pytest.approx(plain_logit(text, folded, 0.1)
                                                                  if text.split() else 0.1)


def test_features_do_not_depend_on_chunks(monkeypatch):
    text = ("Ünï word word  x\n\ty " * 50 + "z" * 500 + " end").encode()
    folded = np.linspace(-1, 1, Q.ROWS).astype(np.float32)
    ids, weights = Q._counted(text)
    whole = Q.logit(text, folded, 0.1)
    monkeypatch.setattr(Q, "CHUNK", 64)
    ids2, weights2 = Q._counted(text)
    assert (ids == ids2).all() and np.allclose(weights, weights2)
    assert Q.logit(text, folded, 0.1) == pytest.approx(whole)
    assert weights.sum() == pytest.approx(1)  # three kinds, each averaged
    assert Q.logit(text, folded, 0.1) == pytest.approx(0.1 + float(weights @ folded[ids]))


def test_folded_weights_equal_the_softmax():
    rng = np.random.default_rng(0)
    sample = [(i, " ".join(rng.choice(["aa", "bb", "cc", "dd"][i % 2:i % 2 + 2], 20)), i % 2)
              for i in range(200)]
    folded, bias = Q.fit(sample)
    scores = [Q.logit(t.encode(), folded, bias) for _, t, _ in sample]
    assert all((s > 0) == (y == 1) for s, (_, _, y) in zip(scores, sample))
    for _, t, _ in sample[:5]:
        ids, weights = Q._counted(t.encode())
        assert Q.logit(t.encode(), folded, bias) == pytest.approx(bias + weights @ folded[ids], abs=1e-5)


def test_toxicity_finds_labelled_documents(tables):
    docs, labels = tables
    rows = T.severities(docs, labels).join(
        labels.withColumnRenamed("toxic", "label"), "doc_id").collect()
    assert sum(r.toxic == r.label for r in rows) >= 0.95 * len(rows)
    for r in rows:
        assert 0 <= r.severity <= 3 and r.grade in range(4)
    mean = {y: np.mean([r.severity for r in rows if r.label == y]) for y in (0, 1)}
    assert mean[1] > 1 > 0.2 > mean[0]


def test_severity_is_the_expected_grade():
    sample = [(i, "calm words here " * 3 + "vile " * (i % 5 if i % 3 == 0 else 0), 0)
              for i in range(300)]
    sample = [(i, t, int("vile" in t)) for i, t, _ in sample]
    kept, w, theta, cutoff = T.fit(sample)
    assert (np.diff(theta) >= 0).all() and 0 < cutoff < 1
    v = T.Vocabulary(kept)
    # one weight vector: the order of documents is the same at every threshold
    x = [sum(w[j] * np.log1p(c) for j, c in v.counts(f"calm {'vile ' * n}").items())
         for n in range(5)]
    assert x == sorted(x) and x[4] > x[1] > x[0]


def test_edge_cases(spark, edge_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (None, 0, 1), (7, None, None)],
                                "doc_id long, quality int, toxic int")
    for labels in (none, one):
        q = Q.quality_scores(clashing(edge_docs), labels).collect()
        t = T.severities(clashing(edge_docs), labels).collect()
        assert len(q) == len(t) == len(EDGES)
        assert len({r.score for r in q}) == 1 and all(0 <= r.score <= 1 for r in q)
        assert all(r.severity == 0 and r.toxic == 0 and r.grade == 0 for r in t)
    assert Q.quality_scores(edge_docs.limit(0), none).count() == 0
    assert T.severities(edge_docs.limit(0), none).count() == 0


def test_samples_are_bounded_and_repeatable(tables):
    docs, labels = tables
    twice = docs.union(docs)
    a = labelled.labelled_sample(docs, labels, "toxic", 50, 4000)
    assert a == labelled.labelled_sample(twice, labels.union(labels), "toxic", 50, 4000)
    assert 25 <= len(a) <= 50 and all(len(t.encode()) <= 4000 for _, t, _ in a)
    b = labelled.text_sample(docs, 100, 4000)
    assert 40 <= len(b) <= 100 and len(set(b)) == len(b)
    everything = labelled.labelled_sample(docs, labels, "toxic", 10_000, 1 << 30)
    assert len(everything) == labels.count()
