"""Exact top-k search by no-random-access aggregation over sorted lists.

Components are integers, floor(scale * x). For every block of candidates each
dimension is a sorted list, read from the top for queries with a positive
component and from the bottom for negative ones. After a depth is read, a
candidate's score lies between a lower bound (unread components at the list's
worst value) and an upper bound (unread components at the list's frontier). The
k-th best lower bound, or the k-th score known from blocks before, is the
threshold: when few candidates can still reach it, reading stops and only those
are resolved to exact scores; otherwise the lists are read deeper. At full depth
the bounds are the scores, so the result is exact.

Bounds of many queries at once are matrix products over clipped columns. Queries
and candidates meet in bounded blocks (query chunk x candidate block); the best
k of all blocks are ranked by a window with a group limit.

Rows equal in id and vector are one row with a count: it is searched once, and
the count is expanded in the ranks.

Defined results: vectors that are null or hold null or non-finite components,
and rows without an id, take no part; a query's candidates are all other rows,
those of its own id and its own copies included; each row with a query's id has
a list of its own (rows of an id are told apart by a 64-bit hash of the vector);
vectors meet only vectors of their own length; ties go to the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_CHUNK, CANDIDATE_BLOCK, LIST_BLOCK = 512, 16_384, 4_096
COPIES_AT_ONCE = 100_000
DEPTHS = (0.5, 0.75, 1.0)
FEW = 0.08                # share of candidates that is resolved rather than read on


def best(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int,
         copies: np.ndarray | None = None):
    """(query index, id, score, rows) of each query's k best of the distinct vectors,
    ordered by query, score from high to low, id. ``copies``: rows behind each
    vector; the query itself is one of those equal to it in id and vector."""
    copies = np.ones(len(ids), np.int64) if copies is None else copies
    top = int(max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0)))
    room = top * top * max(1, vectors.shape[1]) * 4
    kind = np.float32 if room < 2 ** 24 else np.float64 if room < 2 ** 53 else None
    if kind is None:                                   # beyond exact floats: plain integers
        kind = object
    order = np.argsort(ids, kind="stable")
    vectors, ids, copies = vectors[order].astype(kind), ids[order], copies[order]
    up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    known = tuple(np.empty(0, np.int64) for _ in range(4))
    none = -np.inf if kind is not object else -(1 << 200)
    threshold = np.full(len(queries), none, dtype=float if kind is not object else object)
    whole = queries.astype(kind)
    for lo in range(0, len(ids), LIST_BLOCK):
        x, xid, rows = (part[lo:lo + LIST_BLOCK] for part in (vectors, ids, copies))
        lists = np.sort(x, axis=0)                     # ascending; read from either end
        n = len(x)
        own = []                                       # (query, its place in the block)
        for q, (a, b) in enumerate(zip(np.searchsorted(xid, query_ids), np.searchsorted(xid, query_ids, "right"))):
            own += [(q, a + at) for at in np.flatnonzero((x[a:b] == whole[q]).all(axis=1))]
        alone = [(q, at) for q, at in own if rows[at] == 1]      # no other row behind it
        for depth in DEPTHS:
            t = max(1, int(math.ceil(n * depth)))
            high, low = lists[n - t], lists[t - 1]     # frontiers of the two directions
            upper = up @ np.maximum(x, high).T + down @ np.minimum(x, low).T
            floor = threshold
            if n >= k:
                lower = up @ np.where(x >= high, x, lists[0]).T + down @ np.where(x <= low, x, lists[-1]).T
                for q, at in alone:
                    lower[q, at] = none
                kth = np.partition(lower, n - k, axis=1)[:, n - k] if kind is not object else \
                    np.sort(lower, axis=1)[:, n - k]
                floor = np.maximum(threshold, kth)
            left = upper >= floor[:, None]
            for q, at in alone:
                left[q, at] = False
            if depth == 1.0 or left.sum() <= FEW * left.size:
                break
        qi, xi = np.nonzero(left)
        scores = np.empty(len(qi), dtype=np.int64 if kind is not object else object)
        for a in range(0, len(qi), 100_000):
            scores[a:a + 100_000] = (whole[qi[a:a + 100_000]] * x[xi[a:a + 100_000]]).sum(axis=1)
        others = rows[xi]
        for at in own:
            others[(qi == at[0]) & (xi == at[1])] -= 1
        q = np.concatenate([known[0], qi])
        i = np.concatenate([known[1], xid[xi]])
        s = np.concatenate([known[2], scores])
        c = np.concatenate([known[3], others])
        o = np.lexsort((i, -s, q))
        q, i, s, c = q[o], i[o], s[o], c[o]
        first = np.searchsorted(q, np.arange(len(queries)))
        keep = np.arange(len(q)) - first[q] < k
        known = (q[keep], i[keep], s[keep], c[keep])
        count = np.bincount(known[0], minlength=len(queries))
        last = np.cumsum(count) - 1
        full = count >= k
        threshold[full] = known[2][last[full]]
    return known


def search(df: DataFrame, k: int = 20, scale: int = 64, every: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: a list for each row whose id is divisible by ``every``."""
    v = F.col(vector_col)
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.where(fine & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")).alias("v"))
    rows = rows.groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumns({"dim": F.size("v"), "row": F.xxhash64("v")})
    is_query = F.col("id") % every == 0
    n, m = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks, chunks = max(1, math.ceil(n / CANDIDATE_BLOCK)), max(1, math.ceil(m / QUERY_CHUNK))
    h = F.xxhash64("id", "v")
    block, chunk = F.pmod(h, F.lit(blocks)).cast("int"), F.pmod(h, F.lit(chunks)).cast("int")
    spread = (rows.withColumn("q", F.lit(False)).withColumn("block", block)
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    asked = (rows.where(is_query).withColumn("q", F.lit(True)).withColumn("chunk", chunk)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def run(t: pa.Table) -> pa.Table:
        q = t["q"].to_numpy(zero_copy_only=False).astype(bool)
        ids = t["id"].to_numpy()
        x = t["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        copies = t["copies"].to_numpy()
        i, vec, s, c = best(x[q], ids[q], x[~q], ids[~q], k, copies[~q])
        return pa.table({"query_id": pa.array(ids[q][i], pa.int64()),
                         "query_row": pa.array(t["row"].to_numpy()[q][i], pa.int64()),
                         "query_copies": pa.array(copies[q][i], pa.int64()),
                         "vec_id": pa.array(vec, pa.int64()), "score": pa.array(s.astype(np.int64), pa.int64()),
                         "rows": pa.array(np.minimum(c, k), pa.int64())})

    found = (spread.unionByName(asked).groupBy("dim", "chunk", "block")
             .applyInArrow(run, "query_id long, query_row long, query_copies long, vec_id long, score long, rows long"))
    # k distinct vectors a query at most are left before their copies are told
    w = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    firsts = found.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)
    before = F.coalesce(F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lists = firsts.withColumn("before", before).where(F.col("before") < k)
    ranks = F.sequence(F.col("before") + 1, F.least(F.col("before") + F.col("rows"), F.lit(k)))
    told = lists.withColumn("rank", F.explode(ranks))
    # a list for every copy of the query, in runs of a bounded length
    run_of = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("query_copies") - 1) / COPIES_AT_ONCE)))
    told = told.withColumn("run", run_of)
    here = F.least(F.lit(COPIES_AT_ONCE).cast("long"), F.col("query_copies") - F.col("run") * COPIES_AT_ONCE)
    return (told.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), here)))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
