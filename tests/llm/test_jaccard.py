"""The Jaccard join against all pairs of exact sets."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from sitewatch.llm import jaccard_join as J

from .helpers import EDGES, clashing


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(),
                                                    text or ""))
    if 0 < len(words) < 3:
        return {" ".join(words)}
    return {" ".join(words[i:i + 3]) for i in range(len(words) - 2)}


def plain_components(rows):
    """[(doc_id, text)] -> sorted [(doc_id, size, component)]."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(rows)), 2):
        both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        if either and 100 * both >= 90 * either:
            root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {r: min((i for i in ids if i is not None), default=None)
             for r, ids in groups.items()}
    return sorted((str(rows[i][0]), len(sets[i]), str(least[find(i)])) for i in range(len(rows)))


def corpus(seed=5):
    """Families of near-copies (few and many changes), exact copies, a passage that very
    different texts share, and short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=40)
    texts = []
    for size in (12, 30, 60, 120, 300):
        for _ in range(4):
            base = rng.choices(words, k=size)
            texts += [" ".join(base), " ".join(base).upper() + "\n"]
            for changes in (1, 1, 2, 3, 5):
                near = list(base)
                for _ in range(changes):
                    near[rng.randrange(size)] = rng.choice(words)
                texts.append(" ".join(near))
            texts.append(" ".join(base + ["tail"]))
            texts.append(" ".join(passage + base))
    hub = rng.choices(words, k=200)
    for i in range(40):  # one large family, far apart from each other
        near = list(hub)
        for _ in range(rng.choice((1, 2, 3))):
            near[rng.randrange(200)] = f"own{i}"
        texts.append(" ".join(near))
    texts += ["a b c d e f g h i j k", "a b c d e f g h i j k l", "x", "x", "X y", "x y"]
    rng.shuffle(texts)
    return list(enumerate(texts, start=10))


def _check(docs, rows, **limits):
    got = J.near_duplicates(docs, **limits).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) \
        == plain_components(rows)


@pytest.mark.parametrize("limits", [{}, {"small": 2, "block": 4, "longest": 2}])
def test_components_equal_all_pairs(spark, docs_of, limits):
    rows = corpus()
    _check(docs_of(rows), rows, **limits)


def test_edges(spark, edge_docs):
    _check(clashing(edge_docs), EDGES)


def test_empty_table(spark, docs_of):
    got = J.near_duplicates(docs_of([]))
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == 0


def test_other_links_connect_all_alone(spark, docs_of):
    """Without the first comparison, short lists find every link, long lists connect all."""
    rows = corpus(9)
    for limits, whole in (({"small": 1, "block": 5}, False), ({"small": 1000}, True)):
        join = J.Join(docs_of(rows), **limits)
        none = spark.createDataFrame([], "node long, root long")
        found = {tuple(sorted((r.a, r.b))) for r in join.other_links(join.posts(), none).collect()}
        sets = {r.cid: set(np.frombuffer(r.hashes, np.uint64).tolist())
                for r in join.sets_of(join.classes.select("cid")).collect()}
        linked = {(x, y) for x, y in combinations(sorted(sets), 2)
                  if 100 * len(sets[x] & sets[y]) >= 90 * len(sets[x] | sets[y])}
        assert found <= linked and (not whole or found == linked)
        assert _groups(found) == _groups(linked) and linked


def _groups(pairs):
    out = {}
    for x, y in pairs:
        both = out.get(x, {x}) | out.get(y, {y})
        out.update(dict.fromkeys(both, both))
    return {frozenset(g) for g in out.values()}


def test_shared_counts_and_forest(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, k).astype(np.uint64)) for k in (1, 5, 30, 80, 80, 200)]
    monkeypatch.setattr(J, "COLUMNS", 7)
    assert (J._shared(sets) - np.diag(np.diag(J._shared(sets)))
            == [[len(set(a.tolist()) & set(b.tolist())) * (i != j) for j, b in enumerate(sets)]
                for i, a in enumerate(sets)]).all()
    linked = np.zeros((6, 6), bool)
    for a, b in ((0, 3), (3, 5), (0, 5), (1, 2)):
        linked[a, b] = linked[b, a] = True
    assert _groups(J._forest(linked)) == {frozenset({0, 3, 5}), frozenset({1, 2})}
    assert len(J._forest(linked)) == 3


def test_prefix_is_longer_where_lists_are(spark):
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**63, 100).astype(np.uint64))
    rare, need, n_rare = J.prefix(hashes, np.zeros(100, np.uint8), 90)
    assert (len(rare), need, n_rare) == (11, 1, 11)
    common = np.full(100, 80, np.uint8)  # about 2**10 texts hold each shingle
    tokens, need, n_rare = J.prefix(hashes, common, 90)
    assert need > 1 and len(tokens) == 10 + need and n_rare == 0
    mixed = np.arange(100).astype(np.uint8)
    tokens, _, _ = J.prefix(hashes, mixed, 90)
    assert set(tokens[:5].tolist()) == set(hashes[:5].tolist())  # the rarest come first


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    raw = " ".join(f"W{i % 50}" for i in range(500)).encode()
    whole = J.shingle_set(raw, 3)
    monkeypatch.setattr(J, "PIECE", 7)
    assert (J.shingle_set(raw, 3) == whole).all() and len(whole) == 50
