"""Quality rules: base counts against a plain version, verdicts, edge cases, SQL."""

import re

import pytest
from .helpers import EDGES, clashing
from pyspark.sql import functions as F

from sitewatch.llm import quality_rules as Q

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def _check(df, rows):
    got = sorted((r.doc_id is None, r.doc_id, *[r[c] for c in BASE]) for r in df.collect())
    expect = sorted((i is None, i, *plain(t)) for i, t in rows)
    assert got == expect


def test_base_counts_of_edge_texts(edge_docs):
    _check(Q.verdicts(edge_docs), EDGES)


def test_base_counts_of_crafted_texts(docs_of):
    texts = ["a a a a", "a b c a b c", "a b c d", "x\nx\n \n\nx\ny", "#*$%&|<> plain", "a a a b a a a",
             "one two three " * 40, "| a || b <c> &amp;"]
    rows = list(enumerate(texts))
    _check(Q.verdicts(docs_of(rows)), rows)


def test_base_counts_of_the_table(small_docs):
    _check(Q.verdicts(small_docs), [(r.doc_id, r.text) for r in small_docs.collect()])


def test_verdicts_follow_the_labels(spark):
    """Junk that passes the base rules goes, clean documents stay."""
    sf = "/root/testdata/sf0.01"
    out = Q.verdicts(spark.read.parquet(f"{sf}/documents.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = out.where("not base_failed").join(labels, "doc_id").collect()
    assert all(r.kept == (r.quality == 1) for r in rows)
    assert {r.quality for r in rows} == {0, 1}


def test_js_distance(spark):
    df = spark.createDataFrame([([1, 1], [2.0, 2.0]), ([1, 0], [0.0, 5.0]), ([0, 0], [1.0, 1.0]),
                                ([3, 1], [1.0, 3.0])], "p array<int>, q array<double>")
    got = [r.d for r in df.select(Q.js_distance("p", "q").alias("d")).collect()]
    assert got[:3] == [0.0, 1.0, 0.0]
    # by hand: m = (1/2, 1/2), so 3/4 log2(3/2) + 1/4 log2(1/2) on either side
    assert got[3] == pytest.approx((0.75 * 0.5849625007 - 0.25) ** 0.5)


def test_kept_documents_pass_columns_through(small_docs):
    odd = clashing(small_docs)
    out = Q.kept_documents(odd)
    assert out.columns == odd.columns
    ids = {r.doc_id for r in Q.verdicts(small_docs).where("kept").collect()}
    assert {r.doc_id for r in out.collect()} == ids and ids


def test_empty_table_and_unknown_languages(small_docs):
    assert Q.verdicts(small_docs.limit(0)).count() == 0
    odd = small_docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.lit("xx")))
    a = {r.doc_id: r.kept for r in Q.verdicts(odd).collect()}
    b = {r.doc_id: r.kept for r in Q.verdicts(small_docs).collect()}
    assert sum(a[i] != b[i] for i in a) <= len(a) // 20   # the language is found by its words


def test_no_python_in_the_plan(small_docs):
    plan = Q.features(small_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
