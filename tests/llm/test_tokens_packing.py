"""Token counts and packing against the library, round trips and bounds."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sitewatch.llm import packing as P
from sitewatch.llm import token_ids as T
from sitewatch.llm.token_counts import token_counts

from .helpers import EDGES, clashing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n=4000, seed=1):
    rnd = random.Random(seed)
    parts = list("ab 's'T  \n\t\r,.é漢字1٣²½ªµЖ҂ђ \x1c\x85<|>̀​") + [
        "<|endoftext|>", "  ", "'ll", "don't", " \n", "🙂", "²³", "ǆ", " word", " Ünï", "café,"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("memory", [T.MEMORY_WORDS, 50])
def test_ids_equal_the_library(library, monkeypatch, memory):
    monkeypatch.setattr(T, "MEMORY_WORDS", memory)
    texts = odd_texts() + [t or "" for _, t in EDGES]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = T.Encoder(PATH, True).encode(texts)
    assert [np.frombuffer(g, T.IDS).tolist() for g in got] == want
    assert T.Encoder(PATH, False).encode(texts) == [len(w) for w in want]


def test_pieces_of_a_long_text(library, monkeypatch):
    monkeypatch.setattr(T, "GROUP_BYTES", 64)
    text = " ".join(odd_texts(300, 3))
    assert T.Encoder(PATH, False).direct(text) == len(
        library.encode(text, add_special_tokens=False).ids)


def test_other_vocabulary_is_encoded_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = odd_texts(200, 5)
    enc = T.Encoder(path, False)
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert not enc.by_words and enc.encode(texts) == [len(e.ids) for e in want]


def test_token_counts(edge_docs, small_docs, library):
    for docs in (edge_docs, clashing(small_docs)):
        rows = [(r.doc_id, r.text or "") for r in docs.collect()]
        want = sorted((str(i), len(t.encode()), n, n > 1024) for (i, t), n in zip(
            rows, [len(e.ids) for e in library.encode_batch(
                [t for _, t in rows], add_special_tokens=False)]))
        got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit)
                     for r in token_counts(docs, PATH).collect())
        assert got == want
    assert token_counts(small_docs.limit(0), PATH).count() == 0


def _check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_stored_ids(small_docs):
    for ids in ([0], [1, 2**31 - 1, 70_000], list(range(3000))):
        raw = np.array(ids, dtype=T.IDS).tobytes()
        assert P.loaded_ids(P.stored_ids(raw), len(ids)) == raw
    rows = P.pieces(small_docs, PATH, 2048, with_ids=True).collect()
    # what is written and shuffled: half of 32 bits for each id, or less
    assert sum(len(r.ids) for r in rows) <= 2 * sum(r.length for r in rows)


def test_packing_round_trip(edge_docs, library):
    capacity = 64
    rows = P.pack(P.pieces(edge_docs, PATH, capacity, with_ids=True), capacity).collect()
    texts = [t or "" for _, t in EDGES]
    want = {}
    for (i, _), e in zip(EDGES, library.encode_batch(texts, add_special_tokens=False)):
        want.setdefault(i, []).append([*e.ids, 0])
    by = {}
    for r in rows:
        ids = np.array(r.ids, dtype=T.IDS)
        assert r.length == len(ids) and r.ids_crc32 == zlib.crc32(ids.tobytes())
        assert r.length == capacity or r.piece == 0
        by.setdefault((r.doc_id, r.piece, r.start), []).append(r.ids)
    for i, docs in want.items():
        pieces = sorted((p, s, x) for (d, p, s), xs in by.items() if d == i for x in xs)
        assert sum(len(x) for *_, x in pieces) == sum(map(len, docs))
        if len(docs) == 1:
            assert [t for *_, x in pieces for t in x] == docs[0]
            assert [s for _, s, _ in pieces] == np.cumsum(
                [0] + [len(x) for *_, x in pieces])[:-1].tolist()
    sequences = _check_places(rows, capacity)
    assert sequences <= 1.02 * sum(r.length for r in rows) / capacity + 1


def test_packing_the_table(small_docs):
    rows = P.pack(P.pieces(clashing(small_docs), PATH, 2048), 2048).collect()
    n = _check_places(rows, 2048)
    assert n <= 1.02 * sum(r.length for r in rows) / 2048 + 1
    assert {r.doc_id for r in rows} == {r.doc_id for r in small_docs.collect()}
    assert P.pack(P.pieces(small_docs.limit(0), PATH, 2048), 2048).count() == 0


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole_and_as_good_as_best_fit(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 97, 300])
    lengths = [min(capacity, max(1, int(rnd.paretovariate(0.8)))) if seed % 2
               else rnd.randint(1, capacity) for _ in range(1500)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    patterns = P.plan(counts, capacity)
    placed, large = {}, capacity / 3
    for pattern, n in patterns:
        assert n > 0 and sum(size * times for size, times in pattern) <= capacity
        assert sum(times for size, times in pattern if size > large) <= 2
        for size, times in pattern:
            placed[size] = placed.get(size, 0) + times * n
    assert placed == counts
    assert sum(n for _, n in patterns) <= plain_best_fit(lengths, capacity) * 1.01 + 1


def test_one_length_is_ranked_in_many_groups(spark):
    """A third of all pieces share a length; no ranking group holds them all."""
    cut = spark.range(30_000).selectExpr(
        "id AS doc_id", "0 AS piece", "0L AS start",
        "CASE WHEN id % 3 = 0 THEN 7L ELSE id % 90 + 1 END AS length", "id AS ids_crc32")
    packed = P.pack(cut, 100)
    assert _check_places(packed.collect(), 100) <= 1.02 * cut.agg(
        F.sum("length")).first()[0] / 100 + 1
    assert packed.select("doc_id").distinct().count() == 30_000
