"""Best-fit packing with large-item matching.

Pieces above a third of the capacity fit at most twice in one sequence: the longest
is matched with the longest that still fits beside it. Shorter pieces, longest
first, then go to the sequence with the least room that suffices. Equal lengths are
interchangeable, so the plan is made on the histogram of lengths (at most
``capacity`` rows, whatever the number of pieces) and holds patterns with their
number of repeats; Spark ranks the pieces of each length and looks up their places.
Ranking is split by a salt of the row's own number, so that a length shared by a
third of all pieces is ranked in many tasks.

Defined cases: a NULL or empty text is one piece of one token (the end mark);
repeated rows are packed each; an empty table gives no rows; extra columns are
ignored. A piece's row does not depend on the plan except for its place. Very long texts
are cut into pieces of the capacity, whatever their number.

With ``with_ids`` the pieces carry their token ids and the number of their document's row
(rows may repeat a doc_id). Ids are left out of the ranking: places join them by the
piece's own number, in one shuffle of the ids. Until then they are stored by byte planes
(``stored_ids``), compressed.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import ship, written
from sitewatch.llm.token_ids import IDS, by_bytes, encoder

SALTS = 32               # least number of ranking groups per length
ROWS_PER_SALT = 1 << 18  # pieces per salt value
IDS_ROWS = 512           # pieces whose ids are unpacked at once
CODEC = "zstd"


def _cut(raw: bytes, capacity: int):
    """(start, length) of each piece; only the first may be shorter than the capacity."""
    total = len(raw) // 4
    head = (total - 1) % capacity + 1
    return [(0, head)] + [(s, capacity) for s in range(head, total, capacity)]


def stored_ids(part: bytes) -> bytes:
    """Ids (32 bits each), all their lowest bytes first, then the next ones, compressed."""
    planes = np.frombuffer(part, np.uint8).reshape(-1, 4).T.tobytes()
    return pa.Codec(CODEC).compress(planes, asbytes=True)


def loaded_ids(stored: bytes, length: int) -> bytes:
    """The ids of ``stored_ids``."""
    planes = pa.Codec(CODEC).decompress(stored, 4 * length, asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, length).T.tobytes()


def _lists(parts: list[bytes], lengths) -> pa.Array:
    """Lists of ids."""
    ends = np.cumsum([0, *lengths], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(parts), IDS).astype(np.int32))


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int = 0,
           with_ids: bool = False) -> DataFrame:
    """Encode every text, add ``end_id``, cut what exceeds ``capacity``.

    Columns doc_id, piece, start, length, ids_crc32 and, with ``with_ids``, ``doc_row``
    (a number of the row of ``docs``, shared by its pieces alone) and ``ids`` (``stored_ids``).
    """
    ship(docs.sparkSession)
    end = np.array([end_id], dtype=IDS).tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", doc_row long, ids binary" if with_ids else ""
    own = [F.monotonically_increasing_id().alias("doc_row")] if with_ids else []

    def run(batches):
        enc = encoder(vocabulary, True)
        for batch in batches:
            texts, done = pc.fill_null(batch.column(1), ""), 0
            for group in by_bytes(texts):
                out = defaultdict(list)
                keys = batch.column(0).slice(done, len(group)).to_pylist()
                rows = batch.column(2).slice(done, len(group)).to_pylist() if with_ids else keys
                for key, row, raw in zip(keys, rows, enc.encode(group)):
                    raw += end
                    for i, (start, length) in enumerate(_cut(raw, capacity)):
                        part = raw[4 * start:4 * (start + length)]
                        out["doc_id"].append(key)
                        out["piece"].append(i)
                        out["start"].append(start)
                        out["length"].append(length)
                        out["ids_crc32"].append(zlib.crc32(part))
                        if with_ids:
                            out["doc_row"].append(row)
                            out["ids"].append(stored_ids(part))
                done += len(group)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                         pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    return docs.select(F.col("doc_id").cast("long"), "text", *own).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Patterns ((length, times), ...) with their number of sequences.

    ``counts`` maps a length (1 to ``capacity``) to its number of pieces.
    """
    left = dict(counts)
    third = capacity // 3
    rooms: dict[int, list] = defaultdict(list)  # room left -> [pattern, sequences]
    large = sorted((n for n in left if n > third and left[n]), reverse=True)
    for longest in large:
        for partner in [n for n in large if n <= min(longest, capacity - longest)]:
            if partner == longest:
                n = left[longest] // 2
            else:
                n = min(left[longest], left[partner])
            if n:
                left[longest] -= n
                left[partner] -= n
                pattern = ((longest, 2),) if partner == longest else ((longest, 1), (partner, 1))
                rooms[capacity - longest - partner].append([pattern, n])
            if not left[longest]:
                break
        if left[longest]:
            rooms[capacity - longest].append([((longest, 1),), left[longest]])
            left[longest] = 0
    for size in sorted((n for n in left if n <= third and left[n]), reverse=True):
        room = size
        while left[size] and room <= capacity:
            if not rooms[room]:
                room += 1
                continue
            pattern, n = rooms[room].pop()
            # best fit fills a sequence up before it turns to the next
            times = min(room // size, left[size])
            used = min(n, left[size] // times)
            if used < n:
                rooms[room].append([pattern, n - used])
            rooms[room - times * size].append([pattern + ((size, times),), used])
            left[size] -= used * times
        if left[size]:
            times = capacity // size
            if n := left[size] // times:
                rooms[capacity - times * size].append([((size, times),), n])
            if rest := left[size] % times:
                rooms[capacity - rest * size].append([((size, rest),), 1])
            left[size] = 0
    return [(pattern, n) for group in rooms.values() for pattern, n in group]


def _places(patterns, counts: dict[int, int]):
    """Arrays (first rank, length's times, first sequence, offset), ordered by rank.

    Ranks number all pieces, shorter lengths first.
    """
    by_length = defaultdict(list)
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for length, times in pattern:
            by_length[length].append((n, times, sequence, offset))
            offset += length * times
        sequence += n
    rows, rank, first = [], 0, {}
    for length in sorted(counts):
        first[length] = rank
        for n, times, seq, offset in by_length[length]:
            rows.append((rank, times, seq, offset))
            rank += n * times
        assert rank - first[length] == counts[length]
    return np.array(rows, dtype=np.int64).reshape(-1, 4), first


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` from 1 to ``capacity``.

    A column ``ids`` (of ``pieces``) takes no part in the ranking, is joined to the ranks and
    given as lists.
    """
    spark = cut.sparkSession
    ship(spark)
    rows = written(cut.withColumn("_row", F.monotonically_increasing_id()), "packing-pieces")
    total = rows.count()
    salts = max(SALTS, -(-total // ROWS_PER_SALT))
    salted = rows.withColumn("_salt", (F.xxhash64("_row") % salts + salts) % salts)
    groups = written(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")),
                     "packing-groups")
    # at most one row per possible length
    counts = {int(r["length"]): int(r["n"]) for r in
              groups.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    places, first = _places(plan(counts, capacity), counts)
    shared = spark.sparkContext.broadcast((places, first))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0))
                           .alias("_before"))
    within = Window.partitionBy("length", "_salt").orderBy("_row")
    ranked = (salted.withColumn("_rank", F.row_number().over(within) - 1)
              .join(starts, ["length", "_salt"])
              .withColumn("_rank", F.col("_rank") + F.col("_before")))
    with_ids = "ids" in cut.columns
    names = [c for c in cut.columns if c != "ids"]
    types = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    types += ", sequence_id long, offset long"
    if with_ids:
        ranked = ranked.select("_row", *names, "_rank").join(rows.select("_row", "ids"), "_row")
        types += ", ids array<int>"

    def locate(batches):
        table, begin = shared.value
        for batch in (whole.slice(at, IDS_ROWS if with_ids else None) for whole in batches
                      for at in range(0, len(whole), IDS_ROWS if with_ids else max(1, len(whole)))):
            lengths = batch.column(names.index("length")).to_numpy()
            base = np.array([begin[n] for n in lengths.tolist()], dtype=np.int64)
            key = base + batch.column(len(names)).to_numpy()
            slot = table[np.searchsorted(table[:, 0], key, side="right") - 1]
            turn = key - slot[:, 0]
            seq = slot[:, 2] + turn // slot[:, 1]
            offset = slot[:, 3] + turn % slot[:, 1] * lengths
            ids = [_lists([loaded_ids(x, n) for x, n in zip(
                batch.column(len(names) + 1).to_pylist(), lengths.tolist())], lengths)
            ] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(names))], pa.array(seq), pa.array(offset), *ids],
                names=[*names, "sequence_id", "offset", *["ids"] * with_ids])

    return ranked.select(*names, "_rank", *["ids"] * with_ids).mapInArrow(locate, types)
