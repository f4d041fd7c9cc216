"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most ``max_bits`` (4) bits share at least
8 - 4 = 4 of their 8 bytes by position. The index posts every distinct fingerprint
under the bytes at KEY_BYTES (3) positions, for every choice of 3 among the first 7
(a pair with 4 shared positions has 3 of them there), so that lists stay short; beyond
LIST * 256 ** 3 fingerprints at 4 positions of the 8. Within a list members are posted
under each byte that they do not all share, the postings' pairs are tallied, and pairs
that reach the guaranteed minimum are verified by the number of differing bits; others
are never compared. A list hands on a spanning forest of its links, not all pairs: the
components are the same.

Hot lists (over HOT distinct fingerprints) are not held in one task: their members
are posted again under 4 positions, and what is still hot is dealt in blocks whose
pairs are compared in separate tasks. Every link is found by exactly the same test.

Exact copies are one fingerprint, whatever their number. Defined cases: NULL or
empty text has fingerprint 0 and is linked like any other; a text with fewer words
than a shingle is one shingle; a NULL doc_id is a row like any other, ignored in the
smallest doc_id of its component (NULL if there is no other); repeated rows are all
returned; extra columns of any name pass through ``deduplicated``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import ship, written
from sitewatch.llm.components import components

SEED = 42
BYTES = 8
KEY_BYTES = 3
HOT = 2048
BLOCK = 1024
LIST = 256       # lists of chance meetings are kept below this by longer keys
CELLS = 1 << 22  # pairs tallied at once (one list may have more)
CHUNK = 1 << 15  # shingles whose bits are summed at once


def fingerprint(raw: bytes, shingle: int) -> int:
    """Majority bits of the hashes of all shingles (UTF-8 bytes in, unsigned out)."""
    from xxhash import xxh64_digest

    words = raw.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) < shingle:
        parts = [text]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        parts = [text[a:b] for a, b in zip(starts[:len(words) - shingle + 1].tolist(),
                                           ends[shingle - 1:].tolist())]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(parts), CHUNK):
        hashes = b"".join([xxh64_digest(p, SEED) for p in parts[at:at + CHUNK]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(parts)).tobytes(), "big")


def _fingerprints(docs: DataFrame, shingle: int):
    """Column ``fp`` of the documents' texts, as signed numbers."""
    ship(docs.sparkSession)

    @F.arrow_udf("long")
    def fp(text: pa.Array) -> pa.Array:
        values = [fingerprint(t or b"", shingle) for t in text.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(values, dtype=np.uint64).view(np.int64))
    return fp(F.coalesce("text", F.lit(""))).alias("fp")


def _pairs(sizes: np.ndarray):
    """Rows (a, b), a < b, of all pairs within runs of these sizes laid end to end."""
    rows = np.arange(sizes.sum())
    after = np.repeat(np.cumsum(sizes), sizes) - 1 - rows
    a = np.repeat(rows, after)
    return a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)


def _candidates(fps: np.ndarray, sizes: np.ndarray, need: int):
    """Pairs (a, b), a < b, that share at least ``need`` positional bytes within their list.

    ``fps``: the members of lists of these sizes, end to end. Bytes that all members of a
    list share count for each of its pairs; members are posted under the other bytes by
    position, and the pairs of each posting are tallied. In a list whose members share
    ``need`` bytes anyway every pair qualifies without a posting.
    """
    starts = np.cumsum(sizes) - sizes
    own = np.repeat(np.arange(len(sizes)), sizes)
    octets = np.ascontiguousarray(fps).view(np.uint8).reshape(-1, BYTES)
    same = np.logical_and.reduceat(octets == octets[starts[own]], starts)
    known = same.sum(axis=1)
    # cells (a, b) of each list's tally, row by row
    first = np.cumsum(sizes * sizes) - sizes * sizes
    tally = np.repeat(known.astype(np.int8), sizes * sizes)
    at = np.arange(len(fps)) - starts[own]
    row = first[own] + at * sizes[own]
    undecided = known < need
    for p in range(BYTES):
        posted = np.flatnonzero((undecided & ~same[:, p])[own])
        key = own[posted] * 256 + octets[posted, p]
        order = np.argsort(key, kind="stable")
        key, posted = key[order], posted[order]
        cut = np.flatnonzero(np.diff(key, prepend=-1, append=-1))
        a, b = _pairs(np.diff(cut))
        # a pair meets once under a position
        tally[row[posted[a]] + at[posted[b]]] += 1
    found = np.flatnonzero(tally >= need)
    of = np.searchsorted(first, found, side="right") - 1
    a, b = np.divmod(found - first[of], sizes[of])
    a, b, of = a[a < b], b[a < b], of[a < b]
    return starts[of] + a, starts[of] + b


def _links_within(fps: np.ndarray, sizes: np.ndarray, max_bits: int):
    """Spanning forest (a, b) of the links within each of the lists ``fps`` holds end to end."""
    a, b = _candidates(fps, sizes, BYTES - max_bits)
    linked = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
    a, b = a[linked], b[linked]
    root = np.arange(len(fps))
    while True:  # the least row that links reach
        low = np.minimum(root[a], root[b])
        lower = root.copy()
        np.minimum.at(lower, a, low)
        np.minimum.at(lower, b, low)
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    child = np.flatnonzero(root != np.arange(len(fps)))
    return fps[child], fps[root[child]]


def _list_links(fps: np.ndarray, max_bits: int):
    """Spanning forest (a, b) of the links within one list."""
    return _links_within(fps, np.array([len(fps)]), max_bits)


def _lists(n_keys: int, max_bits: int, hot):
    """mapInArrow function over rows (key columns, fp) sorted by the key columns.

    Yields rows (a, b, hot): links, or the members of a list longer than ``hot`` (in a).
    """
    def emit(a, b, is_hot):
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
             pa.array(np.full(len(a), is_hot))], names=["a", "b", "hot"])

    def run(batches):
        # the open list: its key, its members so far, whether it is hot already
        key, held, hot_now = None, np.empty(0, np.uint64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                             for i in range(n_keys)])
            fps = batch.column(n_keys).to_numpy().view(np.uint64)
            cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            starts = np.concatenate(([0], cut))
            ends = np.append(cut, len(fps))
            if key is not None and (keys[:, 0] == key).all():
                first = fps[:ends[0]]
                starts, ends = starts[1:], ends[1:]
                if hot_now:
                    yield emit(first, first, True)
                else:
                    held = np.concatenate((held, first))
            if len(starts):  # the open list has ended; all but the last here are whole
                if hot and not hot_now and len(held) > hot:
                    yield emit(held, held, True)
                elif len(held) > 1 and not hot_now:
                    yield emit(*_list_links(held, max_bits), False)
                size = (ends - starts)[:-1]
                for i in np.flatnonzero(size > hot).tolist() if hot else ():
                    members = fps[starts[i]:ends[i]]
                    yield emit(members, members, True)
                short = (size > 1) & (size <= (hot or len(fps)))
                members = fps[starts[0]:starts[-1]][np.repeat(short, size)]
                size = size[short]
                # lists side by side, as many as have CELLS pairs
                group = np.cumsum(size * size) // CELLS
                for g in np.unique(group):
                    mine = group == g
                    yield emit(*_links_within(members[np.repeat(mine, size)], size[mine],
                                              max_bits), False)
                key, held, hot_now = keys[:, -1], fps[starts[-1]:].copy(), False
            if hot and not hot_now and len(held) > hot:
                yield emit(held, held, True)
                hot_now, held = True, held[:0]
        if len(held) > 1 and not hot_now:
            yield emit(*_list_links(held, max_bits), False)
    return run


def _compared(index: DataFrame, keys: list[str], max_bits: int, hot) -> DataFrame:
    """Links and hot members of every list of ``index`` (key columns and fp)."""
    ship(index.sparkSession)
    dealt = index.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys)
    return written(dealt.mapInArrow(_lists(len(keys), max_bits, hot),
                                    "a long, b long, hot boolean"), "simhash-lists")


def _mask(positions) -> int:
    """The bytes at ``positions`` (0 is the lowest) as a signed 64-bit mask."""
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >> 63 else m


def _posted(fps: DataFrame, choices) -> DataFrame:
    """One row per fingerprint and choice of positions: (choice, its bytes, fp)."""
    lists = F.array(*[F.col("fp").bitwiseAND(F.lit(_mask(c)).cast("long")) for c in choices])
    return fps.select("fp", F.posexplode(lists).alias("choice", "bytes"))


def links(fps: DataFrame, max_bits: int, hot: int = HOT, block: int = BLOCK,
          usual: int = LIST) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fps`` as all links do."""
    need = BYTES - max_bits  # shared positions that every link has
    if need < 1:
        raise ValueError("the index needs fewer differing bits than there are bytes")
    k, n = min(KEY_BYTES, need), fps.count()
    while k < need and n > usual << (8 * k):
        k += 1
    # a link shares `need` of 8 positions, so at least k of the first 8 - (need - k)
    choices = list(combinations(range(BYTES - (need - k)), k))
    found = _compared(_posted(fps, choices), ["choice", "bytes"], max_bits, hot)
    edges, rest = found.where("not hot").select("a", "b"), found.where("hot")
    if rest.isEmpty():
        return edges
    # hot members again under every choice of `need` positions
    again = list(combinations(range(BYTES), need))
    members = rest.select(F.col("a").alias("fp")).distinct()
    index = written(_posted(members, again), "simhash-hot")
    sizes = index.groupBy("choice", "bytes").agg(F.count("*").alias("n"))
    index = index.join(sizes, ["choice", "bytes"])
    small = _compared(index.where(F.col("n") <= hot), ["choice", "bytes"], max_bits, None)
    edges = edges.union(small.select("a", "b"))
    blocks = F.ceil(F.col("n") / block).cast("long")
    large = (index.where(F.col("n") > hot)
             .withColumn("nb", blocks)
             .withColumn("own", (F.xxhash64("fp") % F.col("nb") + F.col("nb")) % F.col("nb"))
             .withColumn("other", F.explode(F.expr("sequence(0L, nb - 1)")))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))
    pairs = _compared(large, ["choice", "bytes", "i", "j"], max_bits, None)
    return edges.union(pairs.select("a", "b"))


def _components(rows: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of ``rows`` (columns doc_id, fp)."""
    own = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    linked = components(links(own.select("fp"), max_bits))
    rooted = written(own.join(linked, own["fp"] == linked["node"]).select("fp", "least", "root"),
                     "simhash-linked")
    # written, so that the joins can split a root or a fingerprint that very many rows have
    best = written(rooted.groupBy("root").agg(F.min("least").alias("_best")), "simhash-roots")
    joined = rooted.join(best, "root").select("fp", "root", "_best")
    return written(own.join(joined, "fp", "left")
                   .select("fp", F.coalesce("root", "fp").alias("root"),
                           F.coalesce("_best", "least").alias("component_id")),
                   "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: one row per row of ``docs``."""
    rows = written(docs.select(F.col("doc_id").cast("long"), _fingerprints(docs, shingle)),
                   "simhash-rows")
    return (rows.join(_components(rows, max_bits), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def deduplicated(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component, the one with its smallest doc_id; columns unchanged."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
        _fingerprints(docs, shingle), row), "simhash-rows")
    ids = rows.select("uid", "doc_id", "fp")
    stay = (ids.join(_components(ids, max_bits), "fp").groupBy("root")
            .agg(F.min_by("uid", F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("uid")))
    kept = rows.select("uid", "row").join(stay.select("uid"), "uid", "left_semi")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
