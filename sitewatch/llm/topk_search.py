"""Exact top-k search by no-random-access aggregation over sorted component lists.

Every component of a block of candidates is a list sorted by value. For a query,
lists with a positive weight are read from the top, others from the bottom, all
sequentially and to the same depth. What has been read gives each candidate a lower
bound (unread parts at the list's worst) and an upper bound (unread parts at the
list's frontier). A candidate is out once its upper bound lies under the query's
k-th best lower bound; a query stops when few candidates are left, and their final
scores are resolved. Bounds of a block are two matrix products per round.

Rows are dealt in blocks: each block of queries meets each block of candidates in a
task of its own, and keeps k rows per query; a window merges them. Scores are exact
integer sums (in 64-bit floats, exact up to 2**53).

Defined cases: vectors that are NULL or hold a NULL or non-finite component take no
part; vectors of different lengths are not compared; a query's own row is every row
with its vec_id (so repeated rows never find themselves); a repeated query row is
answered each time; ties go to the smaller vec_id, NULL ids last; with fewer than k
candidates all are returned; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import ship, written

QUERY_BLOCK = 1024      # queries in a task
CANDIDATE_BLOCK = 8192  # candidates in a task, fewer if their vectors are long
BLOCK_NUMBERS = 1 << 21  # most components of a block, about
AT_ONCE = 256           # queries whose bounds are held at once
DEPTHS = (0.5, 0.75, 0.9, 1.0)  # shares of each list read after each round


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if rows else flat.values
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def nra(queries: np.ndarray, own: np.ndarray, lists: np.ndarray, k: int, few: int = 64):
    """For each query the candidates that can be among its k best, with exact scores.

    ``lists``: candidates x components; ``own[i]``: mask or index array of candidates
    that query i must not find. Yields (query, candidate indices, scores).
    """
    n, dims = lists.shape
    ranked = np.sort(lists, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    active = np.arange(len(queries))
    for depth in DEPTHS:
        if not len(active):
            break
        read = min(n, int(np.ceil(depth * n)))
        if read == n:  # every list read to its end: the bounds meet
            lower = upper = queries[active] @ lists.T
        else:
            top, bottom = ranked[n - read], ranked[read - 1]      # frontiers
            upper = (up[active] @ np.maximum(lists, top).T
                     + down[active] @ np.minimum(lists, bottom).T)
            lower = (up[active] @ np.where(lists >= top, lists, ranked[0]).T
                     + down[active] @ np.where(lists <= bottom, lists, ranked[-1]).T)
        for row, q in enumerate(active):
            lower[row, own[q]] = -np.inf
            upper[row, own[q]] = -np.inf
        if n > k:
            kth = np.partition(lower, n - k, axis=1)[:, n - k]
        else:
            kth = np.full(len(active), -np.inf)
        inside = (upper >= kth[:, None]) & (upper > -np.inf)
        done = inside.sum(axis=1) <= max(few, k)
        if read == n:
            done[:] = True
        for row in np.flatnonzero(done):
            found = np.flatnonzero(inside[row])
            yield active[row], found, lists[found] @ queries[active[row]]
        active = active[~done]


def _block(k: int):
    names = ["_q", "query_id", "vec_id", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            right = right.sort_by([("vec_id", "ascending")])  # NULL ids at the end
            ids = right["vec_id"].to_pylist()
            known = np.array([i if i is not None else 0 for i in ids], dtype=np.int64)
            named = len(ids) - right["vec_id"].null_count
            vectors = _matrix(right["vec"], right.num_rows)
            asked = _matrix(left["vec"], left.num_rows)
            uids, qids = left["_u"].to_numpy(), left["vec_id"].to_numpy()
            for at in range(0, left.num_rows, AT_ONCE):
                q = asked[at:at + AT_ONCE]
                lo = np.searchsorted(known[:named], qids[at:at + AT_ONCE], side="left")
                hi = np.searchsorted(known[:named], qids[at:at + AT_ONCE], side="right")
                own = [slice(a, b) for a, b in zip(lo, hi)]
                for i, found, scores in nra(q, own, vectors, k):
                    best = found[np.argsort(-scores, kind="stable")[:k]]
                    out[0].extend([int(uids[at + i])] * len(best))
                    out[1].extend([int(qids[at + i])] * len(best))
                    out[2].extend(ids[j] for j in best)
                    out[3].extend((vectors[best] @ q[i]).astype(np.int64).tolist())
        return pa.table([pa.array(v, pa.int64()) for v in out], names=names)
    return run


def top_k(vectors: DataFrame, k: int = 5, is_query=None, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row ``is_query`` holds for.

    Components are compared as floor(scale * x). Columns read: vec_id, embedding.
    """
    ship(vectors.sparkSession)
    is_query = F.col("vec_id") % 50 == 0 if is_query is None else is_query
    bad = ("embedding is null or exists(embedding, x -> x is null or isnan(x) "
           "or abs(x) = double('infinity'))")
    rows = vectors.where(f"not ({bad})").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("_dim"),
        F.expr(f"transform(embedding, x -> double(floor({scale} * double(x))))").alias("vec"),
        F.monotonically_increasing_id().alias("_u"),
        F.coalesce(is_query, F.lit(False)).alias("_asks"))
    rows = written(rows, "topk-vectors")
    size = rows.agg(F.count("*").alias("n"), F.count_if("_asks").alias("q"),
                    F.max("_dim").alias("dim")).first()
    most = max(1, BLOCK_NUMBERS // max(1, size["dim"] or 0))
    n_blocks = max(1, -(-size["n"] // min(CANDIDATE_BLOCK, most)))
    q_blocks = max(1, -(-size["q"] // min(QUERY_BLOCK, most)))

    def dealt(df, name, n):
        return df.withColumn(name, F.pmod(F.xxhash64("_u"), F.lit(n)))

    def copied(df, name, n):  # to every block of the other side
        return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>")))

    keys = ["_dim", "_qb", "_cb"]
    asking = copied(dealt(rows.where("_asks"), "_qb", q_blocks), "_cb", n_blocks)
    asked = copied(dealt(rows, "_cb", n_blocks), "_qb", q_blocks)
    near = asking.select(*keys, "_u", "vec_id", "vec").groupBy(*keys).cogroup(
        asked.select(*keys, "vec_id", "vec").groupBy(*keys)).applyInArrow(
        _block(k), "_q long, query_id long, vec_id long, score long")
    best = Window.partitionBy("_q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
