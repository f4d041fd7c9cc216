"""Jaccard join of word n-gram sets by adaptive multi-match prefixes.

Two documents link when the shingle sets they consist of have a Jaccard similarity of at
least ``percent`` / 100, compared in whole numbers. Documents of one set are one class;
classes are joined, documents only get their class's component.

Method. All shingles have one order: estimated frequency, then hash. Sets x and y that
link share at least T = ceil(percent * |x| / 100) shingles, so their first |x| - T + l
shingles (the l-prefix) share at least l, for any l up to T. Every class chooses its own
l: a longer prefix is more to post and look up, but a partner must match l times before
it is verified. The estimate of the cost of l is the postings, plus the entries in their
lists, plus those entries / l verifications (a partner that matches l times is in l of
the lists). A pair must share as many prefix shingles as the smaller l of the two, or more
where their sizes ask for it: sharing S = ceil(percent * (|x| + |y|) / (100 + percent)) in
all, they share at least S - max(T(x) - l(x), T(y) - l(y)) before the earlier end of the two
prefixes.

The frequencies that order the shingles and price the lists come from a table of
counters over all rows (a counter per hash range, at most 2**MOST_BITS codes of one
byte on the driver and in every task, whatever the input). They decide the cost only: any
order gives the same links.

A list of near-copies would be all pairs of its members. First, each list's members are
counted and verified against one member (that with the fewest rare shingles); what links
is one component then, and only lists that still hold several components go on, as pairs
of members of different components: lists of up to SMALL members as a join on the
shingle, longer ones dealt in blocks that meet pairwise, so that none lies in one task.
The members of all long lists with one first member are one group there, as a family of
near-copies shares many lists; in a block the whole sets are compared by a matrix product,
and a spanning forest of the links leaves it, not the pairs. Matches in long lists are not
counted in the join of the short ones, so the pair's limit is lowered there by the long
lists that both are in; pairs that share long lists only are found in the blocks. Every
candidate is verified on the two whole sets.

Sets are twice the size of the texts, so they are made where they are needed, never stored
for all documents: one scan counts and names the sets, one posts their prefixes, and the
texts of candidates alone are shuffled. Their hashes' remainders (at most 2**FILTER_BITS)
are broadcast to sift the scan before that.

Shingles, sets and texts are told by 64-bit hashes (XXH64, XXH3): two different shingles
of two texts of 20,000 words are taken for one with a chance of about 1 in 10**11, two of
n different sets or texts with one of n**2 / 2**65.

Defined cases: NULL or empty texts and texts without words have size 0, are linked with
nothing and are their own component; fewer words than a shingle are one shingle; very
long texts are read whole, in pieces; repeated rows and repeated doc_ids are one class if
their texts are, and all rows are returned; a NULL doc_id is ignored in the smallest
doc_id of a component (NULL if there is no other); an empty table gives no rows; extra
columns of any name are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import discard, ship, written
from sitewatch.llm.components import components

SEED = 42
PIECE = 1 << 15            # shingles hashed at once
LONGEST = 4                # most matches that a prefix may require
SMALL = 32                 # members of a list that meet by a join on its shingle
BLOCK = 256                # members of longer lists that meet in one task
COLUMNS = 4096             # shingles of a block that are counted at once
LEAST_BITS, MOST_BITS = 10, 24
CHUNK = 1 << 14            # counters in one row while they are summed
FILTER_BITS = 20           # remainders of text hashes that sift a scan
OUT_BYTES = 8 << 20        # bytes of sets handed on in one batch
KNOWN = 1 << 20            # sets that a task remembers, to post copies once

ROW_SCHEMA = "doc_id long, h long, n long, cid long, chunk int, counts binary"
POST_SCHEMA = "token long, cid long, info long"  # info: n, need, rare in 32, 8, 24 bits


def shingle_set(raw: bytes, words_each: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a UTF-8 text."""
    from xxhash import xxh64_digest

    words = raw.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    text = b" ".join(words)
    if len(words) <= words_each:
        return np.frombuffer(xxh64_digest(text, SEED), np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - words_each + 1]
    ends = ends[words_each - 1:]
    found = []
    for at in range(0, len(starts), PIECE):
        parts = zip(starts[at:at + PIECE].tolist(), ends[at:at + PIECE].tolist())
        found.append(np.frombuffer(b"".join([xxh64_digest(text[a:b], SEED) for a, b in parts]),
                                   np.uint64))
    return np.unique(np.concatenate(found))


def set_id(hashes: np.ndarray) -> int:
    """The name of a set, as a signed number."""
    from xxhash import xxh3_64_digest

    return int.from_bytes(xxh3_64_digest(hashes.tobytes(), SEED), "big", signed=True)


def _named(words_each: int, bits: int):
    """mapInArrow function: (doc_id, h, text) -> ROW_SCHEMA: a row per document, then this
    task's counters of the shingles, in rows of CHUNK."""
    names = ["doc_id", "h", "n", "cid", "chunk", "counts"]
    shift, most = np.uint64(64 - bits), max(PIECE, 1 << bits >> 3)

    def run(batches):
        held = np.zeros(1 << bits, np.int32)
        for batch in batches:
            sizes, cids, waiting, size = [], [], [], 0
            for text in batch.column(2).cast(pa.binary()):
                found = shingle_set(text.as_py() or b"", words_each)
                sizes.append(len(found))
                cids.append(set_id(found) if len(found) else None)
                waiting.append(found)
                size += len(found)
                if size > most:
                    held += np.bincount((np.concatenate(waiting) >> shift).astype(np.int64),
                                        minlength=1 << bits).astype(np.int32)
                    waiting, size = [], 0
            if waiting:
                held += np.bincount((np.concatenate(waiting) >> shift).astype(np.int64),
                                    minlength=1 << bits).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(cids, pa.int64()), pa.nulls(len(sizes), pa.int32()),
                 pa.nulls(len(sizes), pa.binary())], names=names)
        rows = [held[a:a + CHUNK] for a in range(0, len(held), CHUNK)]
        live = [i for i, r in enumerate(rows) if r.any()]
        if live:
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(len(live), pa.int64())] * 4, pa.array(live, pa.int32()),
                 pa.array([rows[i].tobytes() for i in live], pa.binary())], names=names)
    return run


def _codes(mean: float):
    """mapInArrow function: counters sorted by chunk -> eight times the binary logarithm
    of each sum above the mean, as bytes."""
    def code(total):
        return np.minimum(255, np.rint(8 * np.log2(np.maximum(1, total - mean + 1)))) \
            .astype(np.uint8).tobytes()

    def run(batches):
        now, total = None, None
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                here = np.frombuffer(counts.as_py(), np.int32).astype(np.int64)
                if chunk == now:
                    total = total + here
                    continue
                if now is not None:
                    yield pa.RecordBatch.from_pydict({"chunk": pa.array([now], pa.int32()),
                                                      "codes": [code(total)]})
                now, total = chunk, here
        if now is not None:
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([now], pa.int32()),
                                              "codes": [code(total)]})
    return run


def counter_bits(text_bytes: int) -> int:
    """Bits of the hash ranges: about 256 shingles each, within bounds."""
    return min(max((text_bytes // 6).bit_length() - 8, LEAST_BITS), MOST_BITS)


def frequency_codes(rows: DataFrame, bits: int) -> np.ndarray:
    """A code of one byte per hash range: its estimated frequency, logarithmically."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    counters = rows.where("chunk IS NOT NULL").select("chunk", "counts")
    codes = np.zeros(1 << bits, np.uint8)
    for row in counters.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(
            _codes(total / (1 << bits)), "chunk int, codes binary").collect():
        part = np.frombuffer(row["codes"], np.uint8)
        codes[row["chunk"] * CHUNK:row["chunk"] * CHUNK + len(part)] = part
    return codes


def may_link(n: int, percent: int) -> bool:
    """Whether a set of this size can link with any other set (one shingle more, at best)."""
    return 100 * n >= percent * (n + 1)


def prefix(hashes: np.ndarray, code: np.ndarray, percent: int, longest: int = LONGEST):
    """(prefix, needed matches, rare shingles in it) at the least estimated cost.

    ``hashes`` are sorted, ``code`` are their frequency codes.
    """
    n = len(hashes)
    least = (percent * n + 99) // 100  # shingles shared with any partner
    base = n - least
    longest = min(longest, least)
    order = np.argsort(code, kind="stable")[:base + longest]
    entries = np.cumsum(np.exp2(code[order] / 8.0) - 1)
    matches = np.arange(1, longest + 1)
    lists = entries[base + matches - 1]
    cost = 2.0 * (base + matches) + lists + lists / matches * (4 + n / 32)
    need = int(matches[np.argmin(cost)])
    chosen = order[:base + need]
    return hashes[chosen], need, int((code[chosen] == 0).sum())


def _prefixes(shared, words_each: int, percent: int, longest: int):
    """mapInArrow function: text -> POST_SCHEMA, sets that repeat in the task mostly once."""
    def run(batches):
        codes = shared.value
        shift = np.uint64(64 - (len(codes).bit_length() - 1))
        known = set()
        for batch in batches:
            tokens, cids, infos = [], [], []
            for text in batch.column(0).cast(pa.binary()):
                hashes = shingle_set(text.as_py() or b"", words_each)
                n = len(hashes)
                if not may_link(n, percent):
                    continue
                cid = set_id(hashes)
                if cid in known:
                    continue
                if len(known) == KNOWN:
                    known.clear()
                known.add(cid)
                token, need, rare = prefix(hashes, codes[hashes >> shift], percent, longest)
                tokens.append(token)
                cids.append(cid)
                infos.append(n << 32 | need << 24 | min(rare, (1 << 24) - 1))
            if tokens:
                times = [len(t) for t in tokens]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)),
                     *[pa.array(np.repeat(np.array(c, np.int64), times)) for c in (cids, infos)]],
                    names=["token", "cid", "info"])
    return run


def _sets(words_each: int):
    """mapInArrow function: (cid, text) -> (cid, hashes) of the texts that have that set."""
    def run(batches):
        for batch in batches:
            cids, sets, size = [], [], 0
            for cid, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                found = shingle_set(text.as_py() or b"", words_each)
                if set_id(found) == cid:
                    cids.append(cid)
                    sets.append(found.tobytes())
                    size += len(sets[-1])
                if size > OUT_BYTES:
                    yield pa.RecordBatch.from_pydict(
                        {"cid": pa.array(cids, pa.int64()), "hashes": pa.array(sets, pa.binary())})
                    cids, sets, size = [], [], 0
            if cids:
                yield pa.RecordBatch.from_pydict(
                    {"cid": pa.array(cids, pa.int64()), "hashes": pa.array(sets, pa.binary())})
    return run


def _similar(percent: int):
    """mapInArrow function: (a, b, ha, hb) -> the pairs (a, b) that link."""
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
    return run


def _shared(sets) -> np.ndarray:
    """Numbers of common shingles of all pairs of ``sets`` (exact: they are below 2**24)."""
    sizes = [len(x) for x in sets]
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    several = times[at] > 1
    rows, at = np.repeat(np.arange(len(sets)), sizes)[several], column[at[several]]
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(column[-1]) + 1, COLUMNS):
        first, last = np.searchsorted(at, (low, low + COLUMNS))
        table = np.zeros((len(sets), COLUMNS), np.float32)
        table[rows[first:last], at[first:last] - low] = 1
        out += table @ table.T
    return out


def _forest(linked: np.ndarray):
    """Edges (i, j) of a spanning forest of a symmetric boolean matrix."""
    left, out = np.ones(len(linked), bool), []
    for start in range(len(linked)):
        waiting = [start] if left[start] else []
        left[start] = False
        while waiting:
            i = waiting.pop()
            found = np.flatnonzero(linked[i] & left)
            left[found] = False
            waiting += found.tolist()
            out += [(i, j) for j in found.tolist()]
    return out


def _block_links(percent: int):
    """mapInArrow function: (group, i, j, cid, comp, hashes) sorted by the first three -> links
    (a, b) between members of different components."""
    def links(held):
        cid, comp, sets = zip(*held)
        sets = [np.frombuffer(h, np.uint64) for h in sets]
        comp, n = np.array(comp), np.array([len(x) for x in sets])
        if (comp == comp[0]).all():
            return pa.RecordBatch.from_pydict({"a": pa.array([], pa.int64()),
                                               "b": pa.array([], pa.int64())})
        both = _shared(sets).astype(np.int64)
        found = _forest((100 * both >= percent * (n[:, None] + n[None, :] - both))
                        & (comp[:, None] != comp[None, :]))
        return pa.RecordBatch.from_pydict({"a": pa.array([cid[i] for i, _ in found], pa.int64()),
                                           "b": pa.array([cid[j] for _, j in found], pa.int64())})

    def run(batches):
        now, held = None, []
        for batch in batches:
            for group, i, j, *member in zip(*[c.to_pylist() for c in batch.columns]):
                if (group, i, j) != now:
                    if len(held) > 1:
                        yield links(held)
                    now, held = (group, i, j), []
                held.append(member)
        if len(held) > 1:
            yield links(held)
    return run


def _matches(x: str, y: str, percent: int) -> str:
    """SQL: prefix shingles that sets with sizes n and matches need (of the prefixes ``x`` and
    ``y`` of the columns' names) share if they link."""
    rest = ", ".join(f"({percent} * {p}n + 99) div 100 - {p}need" for p in (x, y))
    all_ = f"({percent} * ({x}n + {y}n) + {99 + percent}) div {100 + percent}"
    return f"greatest(least({x}need, {y}need), {all_} - greatest({rest}))"


def _alike(a: str, b: str, percent: int) -> str:
    """SQL: sets of these sizes can link."""
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


class Join:
    """Classes of a documents table and the links between them."""

    def __init__(self, docs: DataFrame, words_each: int = 3, percent: int = 90,
                 longest: int = LONGEST, small: int = SMALL, block: int = BLOCK):
        self.spark, self.percent, self.small, self.block = docs.sparkSession, percent, small, block
        self.words_each, self.longest = words_each, longest
        ship(self.spark)
        text = F.coalesce("text", F.lit(""))
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 F.xxhash64(text).alias("h"), text.alias("text"))
        size = self.texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.bits = counter_bits(size)
        self.rows = written(self.texts.mapInArrow(_named(words_each, self.bits), ROW_SCHEMA),
                            "jaccard-rows")
        self.classes = written(self.rows.where("cid IS NOT NULL").groupBy("cid").agg(
            F.min("h").alias("h"), F.min("doc_id").alias("least")), "jaccard-classes")

    def posts(self) -> DataFrame:
        """Prefix postings (token, cid, n, need) of lists with two members or more, the list's
        members f and the member that the others are compared with first (p_...)."""
        codes = self.spark.sparkContext.broadcast(frequency_codes(self.rows, self.bits))
        posted = self.texts.select("text").mapInArrow(
            _prefixes(codes, self.words_each, self.percent, self.longest), POST_SCHEMA)
        index = written(posted, "jaccard-index")
        several = written(index.groupBy("token").agg(F.min("cid").alias("lo"),
                                                     F.max("cid").alias("hi"))
                          .where("lo < hi").select("token"), "jaccard-tokens")
        met = written(index.join(several, "token"), "jaccard-met")
        discard(index)
        # copies that different tasks posted
        once = written(met.groupBy("token", "cid").agg(F.max("info").alias("info")),
                       "jaccard-once")
        first = F.min(F.struct(F.expr("info & 16777215").alias("rare"), "cid", "info"))
        lists = written(once.groupBy("token").agg(F.count("*").alias("f"), first.alias("p"))
                        .select("token", "f", F.col("p.cid").alias("p_cid"),
                                F.col("p.info").alias("p_info")), "jaccard-lists")
        fields = [F.expr(f"{e} AS {p}{name}") for p in ("", "p_") for name, e in (
            ("n", f"shiftright({p}info, 32)"),
            ("need", f"CAST(shiftright({p}info, 24) & 255 AS INT)"))]
        return written(once.join(lists, "token").select("token", "cid", "f", "p_cid", *fields),
                       "jaccard-posts")

    def sets_of(self, ends: DataFrame) -> DataFrame:
        """cid, hashes of the classes in ``ends`` (column cid)."""
        wanted = written(self.classes.join(ends, "cid").select("cid", "h"), "jaccard-wanted")
        sieve = wanted.select(F.expr(f"h & {(1 << FILTER_BITS) - 1}").alias("low")).distinct()
        sifted = self.texts.select("h", "text", F.expr(
            f"h & {(1 << FILTER_BITS) - 1}").alias("low")).join(
            F.broadcast(sieve), "low", "left_semi")  # at most 2**FILTER_BITS numbers
        texts = sifted.groupBy("h").agg(F.first("text").alias("text"))
        return written(wanted.join(texts, "h").select("cid", "text").mapInArrow(
            _sets(self.words_each), "cid long, hashes binary"), "jaccard-sets")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets link."""
        pairs = written(pairs, "jaccard-candidates")
        ends = {c: written(pairs.select(F.col(c).alias("cid")).distinct(), "jaccard-ends")
                for c in "ab"}
        sets = self.sets_of(ends["a"].union(ends["b"]).distinct())
        x, y = (sets.join(ends[c], "cid", "left_semi").select(
            F.col("cid").alias(c), F.col("hashes").alias(f"h{c}")) for c in "ab")
        both = pairs.join(x, "a").join(y, "b").select("a", "b", "ha", "hb")
        found = written(both.mapInArrow(_similar(self.percent), "a long, b long"),
                        "jaccard-links")
        discard(sets)
        return found

    def first_candidates(self, posts: DataFrame) -> DataFrame:
        """Members against the first member of their lists, if they meet there often."""
        return (posts.where("cid <> p_cid").where(_alike("n", "p_n", self.percent))
                .groupBy("cid", "p_cid").agg(
                    F.count("*").alias("shared"),
                    F.max(F.expr(_matches("", "p_", self.percent))).alias("least"))
                .where("2 * shared >= least")  # the first member need not be that of all lists
                .select(F.col("cid").alias("a"), F.col("p_cid").alias("b")))

    def _open_posts(self, posts: DataFrame, known: DataFrame) -> DataFrame:
        """The postings, with components and the class's long lists, of lists that hold members
        of several components of ``known``."""
        long_lists = posts.where(F.col("f") > self.small).groupBy("cid").agg(
            F.count("*").alias("hot"))
        labelled = written(
            posts.join(known.withColumnRenamed("node", "cid"), "cid", "left")
            .join(long_lists, "cid", "left")
            .select("token", "cid", "n", "need", "f", "p_cid",
                    F.coalesce("root", "cid").alias("comp"),
                    F.coalesce("hot", F.lit(0)).alias("hot")), "jaccard-labelled")
        several = written(labelled.groupBy("token").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
            .select("token"), "jaccard-open")
        return written(labelled.join(several, "token"), "jaccard-open-posts")

    def short_candidates(self, open_: DataFrame) -> DataFrame:
        """Pairs of different components that match often enough, by lists of up to ``small``."""
        x, y = (open_.where(F.col("f") <= self.small).alias(s) for s in "xy")
        met = x.join(y, F.expr("x.token = y.token AND x.cid < y.cid AND x.comp <> y.comp AND "
                               + _alike("x.n", "y.n", self.percent)))
        return (met.groupBy(F.col("x.cid").alias("a"), F.col("y.cid").alias("b")).agg(
            F.count("*").alias("shared"),
            F.max(F.expr(_matches("x.", "y.", self.percent) + " - least(x.hot, y.hot)"))
            .alias("least")).where("shared >= least").select("a", "b"))

    def long_links(self, open_: DataFrame) -> DataFrame:
        """Links between different components within lists of more than ``small`` members."""
        members = written(open_.where(F.col("f") > self.small)
                          .select(F.col("p_cid").alias("group"), "cid", "comp").distinct(),
                          "jaccard-members")
        sizes = written(members.groupBy("group").agg(
            F.ceil(F.count("*") / self.block).cast("long").alias("nb")), "jaccard-groups")
        sets = self.sets_of(members.select("cid").distinct())
        dealt = (members.join(sizes, "group").join(sets, "cid")
                 .withColumn("own", F.expr("pmod(xxhash64(cid), nb)"))
                 .withColumn("other", F.explode(F.expr("sequence(0L, nb - 1)")))
                 .select("group", F.least("own", "other").alias("i"),
                         F.greatest("own", "other").alias("j"), "cid", "comp", "hashes"))
        key = ["group", "i", "j"]
        return written(dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(
            _block_links(self.percent), "a long, b long"), "jaccard-long")

    def other_links(self, posts: DataFrame, known: DataFrame) -> DataFrame:
        """Links that connect the components of ``known`` as all links do."""
        open_ = self._open_posts(posts, known)
        return self.verified(self.short_candidates(open_)).union(self.long_links(open_))

    def links(self) -> DataFrame:
        """Links (a, b) between classes that connect them as all links do."""
        posts = self.posts()
        first = self.verified(self.first_candidates(posts))
        known = written(components(first), "jaccard-known")
        return first.union(self.other_links(posts, known))

    def documents(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row."""
        found = written(components(self.links()).distinct(), "jaccard-components")
        rooted = written(self.classes.join(found, F.col("cid") == F.col("node"), "left").select(
            "cid", F.coalesce("root", "cid").alias("root"), "least"), "jaccard-rooted")
        best = written(rooted.groupBy("root").agg(F.min("least").alias("best")), "jaccard-best")
        each = written(rooted.join(best, "root").select("cid", "best"), "jaccard-named")
        return (self.rows.where("chunk IS NULL").join(each, "cid", "left")
                .select("doc_id", F.col("n").alias("n_shingles"),
                        F.expr("IF(cid IS NULL, doc_id, best)").alias("component_id")))


def near_duplicates(docs: DataFrame, words_each: int = 3, percent: int = 90, **limits) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``."""
    return Join(docs, words_each, percent, **limits).documents()
