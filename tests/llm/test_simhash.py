"""SimHash groups against brute force, hot lists, edge cases."""

import random

import numpy as np
import pyarrow as pa
import xxhash
from .helpers import EDGES, clashing

from sitewatch.llm import simhash_dedup as S
from sitewatch.llm.components import components


def plain_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, bits=4):
    """[(doc_id, fp)] -> component id of each row, by repeated least neighbours."""
    fps = np.array([f for _, f in rows], dtype=np.uint64)
    big = 1 << 60
    ids = np.array([big if i is None else i for i, _ in rows])
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    while True:
        new = np.where(near, ids[None, :], big).min(axis=1)
        if (new == ids).all():
            return [None if i == big else int(i) for i in ids]
        ids = new


def _check(docs, rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    expect = sorted(((str(i), f"{f:016x}", str(c)) for (i, f), c in zip(fps, plain_groups(fps))))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id))
                 for r in S.near_duplicates(docs).collect())
    assert got == expect


def test_table_against_brute_force(small_docs):
    _check(small_docs, [(r.doc_id, r.text) for r in small_docs.collect()])


def test_edge_texts(edge_docs):
    rows = [(i, t) for i, t in EDGES if t is None or len(t) < 1000] + [
        (i, t) for i, t in EDGES if t is not None and len(t) >= 1000]
    _check(edge_docs, rows)


def test_long_text_is_summed_in_chunks():
    text = " ".join(f"w{i % 977}x{i}" for i in range(S.CHUNK + 1000))
    words = text.split()
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(words[i:i + 4]), 42)
                       for i in range(len(words) - 3)], dtype=np.uint64)
    expect = sum(1 << b for b in range(64)
                 if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))
    assert S.fingerprint(text.encode(), 4) == expect


def _clusters(seed=5, centers=30, each=20, far=3):
    rnd = random.Random(seed)
    out = set()
    for _ in range(centers):
        base = rnd.getrandbits(64)
        for _ in range(each):
            f = base
            for b in rnd.sample(range(64), rnd.randint(0, far)):
                f ^= 1 << b
            out.add(f)
    return sorted(out)


def _partition(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def _signed(f):
    return f - (1 << 64) if f >> 63 else f


def test_links_keep_every_component(spark):
    """With and without hot lists, down to blocks of hot lists."""
    fps = _clusters() + [1 << b for b in range(40)]
    fps = sorted(set(fps))
    array = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 4
    expect = _partition([(_signed(fps[i]), _signed(fps[j])) for i, j in zip(*np.nonzero(near))],
                        [_signed(f) for f in fps])
    df = spark.createDataFrame([(_signed(f),) for f in fps], "fp long")
    for hot, block in ((2048, 1024), (8, 4), (2, 2)):
        pairs = [(r.a, r.b) for r in S.links(df, 4, hot, block).collect()]
        assert all(bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 64 for a, b in pairs)
        assert _partition(pairs, list(expect)) == expect, (hot, block)


def test_list_over_two_batches_that_ends_in_the_second(monkeypatch):
    """A list is hot by its whole length, wherever the batches cut it."""
    compared = []
    real = S._list_links
    monkeypatch.setattr(S, "_list_links", lambda fps, bits: compared.append(len(fps)) or real(fps, bits))

    def batch(keys, fps):
        return pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in (keys, fps)],
                                          names=["key", "fp"])

    def run(*batches):
        out = [r for b in S._lists(1, 4, 2048)(iter(batches)) for r in b.to_pylist()]
        return sorted(r["a"] for r in out if r["hot"]), [r for r in out if not r["hot"]]

    fps = list(range(11_000))
    hot, links = run(batch([1] * 2000, fps[:2000]), batch([1] * 9000 + [2, 2], fps[2000:] + [1, 3]))
    assert hot == fps and max(compared) <= 2048
    assert [(r["a"], r["b"]) for r in links] == [(3, 1)]
    compared.clear()
    hot, _ = run(batch([1] * 1000, fps[:1000]), batch([1] * 1048 + [2], fps[1000:2048] + [1]))
    assert hot == [] and compared == [2048]


def test_candidates_are_the_pairs_that_share_enough_bytes():
    """Lists of chance meetings, of families and of bytes shared by all, side by side."""
    rnd = random.Random(4)
    lists = [[rnd.getrandbits(64) for _ in range(n)] for n in (2, 3, 40)]
    lists += [[rnd.getrandbits(24) | 0xAB << 56 for _ in range(30)],
              [rnd.getrandbits(8) for _ in range(25)], _clusters(seed=3, centers=2),
              [sum(rnd.randrange(2) << 8 * p for p in range(8)) for _ in range(50)]]
    fps = np.array(sum(lists, []), np.uint64)
    sizes = np.array([len(x) for x in lists])
    octets = fps.view(np.uint8).reshape(-1, 8)
    own = np.repeat(np.arange(len(lists)), sizes)
    for need in (1, 2, 4, 6, 8):
        a, b = S._candidates(fps, sizes, need)
        expect = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))
                  if own[i] == own[j] and (octets[i] == octets[j]).sum() >= need}
        assert len(a) == len(expect) and set(zip(a.tolist(), b.tolist())) == expect


def test_chance_meetings_are_not_compared():
    """Members of a list that share its three key bytes alone are no candidates."""
    rnd = np.random.default_rng(6)
    fps = rnd.integers(0, 1 << 40, 2000, dtype=np.uint64) | np.uint64(0xABCDEF << 40)
    a, _ = S._candidates(fps, np.array([2000]), 4)
    assert 0 < len(a) < 0.03 * 2000 * 1999 / 2


def test_longer_keys_for_larger_tables(spark):
    fps = _clusters(seed=12)
    array = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 4
    expect = _partition([(_signed(fps[i]), _signed(fps[j])) for i, j in zip(*np.nonzero(near))],
                        [_signed(f) for f in fps])
    df = spark.createDataFrame([(_signed(f),) for f in fps], "fp long")
    pairs = [(r.a, r.b) for r in S.links(df, 4, usual=0).collect()]
    assert _partition(pairs, list(expect)) == expect


def test_other_distances(spark):
    fps = _clusters(seed=9, far=2)
    array = np.array(fps, dtype=np.uint64)
    df = spark.createDataFrame([(_signed(f),) for f in fps], "fp long")
    for bits in (0, 2, 6, 7):
        near = np.bitwise_count(array[:, None] ^ array[None, :]) <= bits
        expect = _partition([(_signed(fps[i]), _signed(fps[j])) for i, j in zip(*np.nonzero(near))],
                            [_signed(f) for f in fps])
        pairs = [(r.a, r.b) for r in S.links(df, bits).collect()]
        assert _partition(pairs, list(expect)) == expect, bits


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1400)]
    edges += [(5000 + i, 5000 + rnd.randrange(60)) for i in range(60)] + [(7, 7), (9001, 9001)]
    rnd.shuffle(edges)
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    expect = _partition(edges, {n for e in edges for n in e})
    df = spark.createDataFrame([e if rnd.random() < .5 else e[::-1] for e in edges] * 2,
                               "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {n: expect[n] for n in nodes}
    assert components(df.limit(0)).count() == 0


def test_deduplicated_keeps_one_row_per_group(small_docs, docs_of):
    odd = clashing(small_docs.union(small_docs))   # every row repeated
    out = S.deduplicated(odd)
    assert out.columns == odd.columns
    got = sorted(r.doc_id for r in out.select("doc_id").collect())
    groups = {r.component_id for r in S.near_duplicates(small_docs).collect()}
    assert got == sorted(groups)
    assert S.deduplicated(small_docs.limit(0)).count() == 0
    nulls = docs_of([(None, "a b c d e"), (None, "a b c d e"), (None, "quite another text here")])
    assert S.deduplicated(nulls).count() == 2
