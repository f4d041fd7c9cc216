"""The filter and source audits against their plain definitions."""

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from sitewatch.llm import divergence as D
from sitewatch.llm import filter_audit as A

from .helpers import EDGES, clashing

LABELS = "doc_id long, quality int, toxic int"


def plain_fails(rows):
    """[(doc_id, text, lang)] -> the letters that each row fails."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append("".join(c for c, failed in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 10 * len(t), re.search("[#$%&*|]", t),
            i is not None and least[t] < i)) if failed))
    return out


def plain_audit(rows, labels):
    marks = {}
    for i, good, toxic in labels:
        if i is None:
            continue  # a NULL doc_id has no label
        g, x = marks.get(i, (False, False))
        marks[i] = (g or good == 1, x or toxic == 1)
    fails = plain_fails(rows)
    parts = {}
    for (i, _, lang), f in zip(rows, fails):
        parts.setdefault(lang or "", []).append((f, *marks.get(i, (False, False))))
    out = []
    for part, docs in parts.items():
        shapley = Counter()
        lines = []
        for order in map("".join, permutations("ABCDE")):
            for step, own in enumerate(order, start=1):
                here = [d for d in docs if own in d[0]]
                removed = [d for d in here if not set(d[0]) & set(order[:step - 1])]
                shapley[own] += len(removed)
                lines.append((part, order, step, own,
                              sum(not set(d[0]) & set(order[:step]) for d in docs), len(removed),
                              len(here) - len(removed), sum(d[0] == own for d in docs),
                              sum(d[1] for d in removed), sum(d[2] for d in removed)))
        out += [(*x[:3], *x[4:], shapley[x[3]]) for x in lines]
    return sorted(out)


def _audit(df):
    return sorted(tuple(r) for r in df.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley").collect())


def test_filter_audit_equals_plain_counts(spark, docs_of):
    clean = " ".join(f"word{i}" for i in range(120))
    rows = [(i, t, "en") for i, t in EDGES] + [
        (20, clean, "en"), (21, clean, "de"), (19, clean, None), (22, clean + " #", "en"),
        (23, clean.upper(), ""), (24, clean.upper(), "de"), (25, "same " * 150, "en"),
        (26, "same " * 150, "de"), (None, clean, "en"), (None, clean, "de"), (27, clean + "&", "de")]
    labels = [(20, 1, 0), (21, 1, 1), (21, 0, 0), (22, None, 1), (25, 0, 1), (99, 1, 1),
              (None, 1, 1), (24, 1, 0)]
    got = A.audit(clashing(docs_of(rows)), spark.createDataFrame(labels, LABELS))
    assert _audit(got) == plain_audit(rows, labels)


def test_filter_audit_of_many_copies(spark, docs_of):
    """One text makes up most of the table: one row of it is no copy."""
    rows = [(i, "the same text" if i % 5 else f"text {i}", "en") for i in range(400)]
    got = A.audit(docs_of(rows), spark.createDataFrame([], LABELS))
    assert _audit(got) == plain_audit(rows, [])


def test_filter_audit_empty(spark, docs_of):
    assert A.audit(docs_of([]), spark.createDataFrame([], LABELS)).count() == 0


def plain_divergence(rows, min_docs, top):
    """[(text, lang, source)] -> sorted (lang, source, part, item, value, rank)."""
    docs, counts, groups = Counter(), {}, set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))
        docs.update((lang, t) for t in found)
        counts.setdefault((lang, source), Counter()).update(found)
    out = []
    for lang, source in groups:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= min_docs]
        own = {s: [counts[g, s][t] for t in kept] for g, s in groups if g == lang}
        own[None] = [sum(c) for c in zip(*own.values())]
        p = {s: [1 + 10**9 * (c + 5) // (sum(n) + 5 * len(kept)) for c in n]
             for s, n in own.items()}
        pairs = [(sum(abs(a - b) for a, b in zip(p[source], p[s])), s)
                 for s in own if s not in (source, None)]
        terms = [(a - q, t) for t, c, a, q in zip(kept, own[source], p[source], p[None])
                 if c and a > q]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, i)
                    for i, (value, item) in enumerate(found[:most], start=1)]
    return sorted(out)


ROWS = [(f"{a} Word{i % 3} {b} tail-{i % 2} çà Ünder_score {'rare' * (i % 5 == 0)} {a * (i % 4)}",
         lang, source)
        for i, (a, b, lang, source) in enumerate(
            (a, b, lang, source) for a in ("aa", "Bb", "ccc") for b in ("dd", "É", "f1f")
            for lang, source in (("en", "s1"), ("en", "s2"), ("en", None), (None, "s1"),
                                 ("de", "s1"), ("de", "s9")))]
ROWS += [(None, "en", "s3"), ("", "en", "s4"), ("12 34", "fr", "s1"), ("12", "fr", "s2"),
         ("x" * 50_000 + " aa" * 20_000, "en", "s2")]


@pytest.mark.parametrize("limits", [{}, {"block": 3}, {"block": 2, "sources": 1}])
def test_divergence_equals_plain_sums(spark, docs_of, limits):
    docs = clashing(docs_of([(i, *r) for i, r in enumerate(ROWS)]))
    for min_docs, top in ((3, 50), (1, 2)):
        got = D.audit(docs, min_docs, top, **limits).collect()
        assert sorted(tuple(r) for r in got) == plain_divergence(ROWS, min_docs, top)


def test_divergence_hands_counts_on_in_parts(spark, docs_of, monkeypatch):
    monkeypatch.setattr(D, "FLUSH", 1)
    docs = docs_of([(i, *r) for i, r in enumerate(ROWS)])
    assert sorted(tuple(r) for r in D.audit(docs, 2).collect()) == plain_divergence(ROWS, 2, 50)


def test_divergence_empty_and_alone(spark, docs_of):
    assert D.audit(docs_of([])).count() == 0
    assert D.audit(docs_of([(1, "a b", "en", "s")])).count() == 0
    two = D.audit(docs_of([(1, "a b", "en", "s"), (2, None, "en", "t")]))
    assert sorted(tuple(r) for r in two.collect()) == [
        ("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    assert two.where(F.col("part") == "term").count() == 0
