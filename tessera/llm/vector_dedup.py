"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine >= t lie within squared distance 2 - 2t. They are
rotated by a fixed orthogonal matrix and split into low-dimensional blocks; a
pair within that distance is, in at least one block, within the block's share of
it (in proportion to its dimensions). Each block is a range join: vectors fall
into cells of that width along the block's first coordinate and meet their own
and the next cell only. The distance in the block is tested, and what is left is
verified on the given vectors in double precision.

A pair is counted in the first block that qualifies, so nothing is counted twice
and no pair is emitted: a task returns link counts per vector and a spanning
forest of the links it found. Cells above a bound are cut into chunks that meet
pairwise, so no task gets an unbounded group. Equal vectors are one vector with
a count.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing, and vectors of different length never link; each
is a component of its own. A null id links with nothing and is not kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch_column
from tessera.llm.graph import components
from tessera.session import scratch_path

BLOCK_DIMS, CHUNK, ROWS_AT_ONCE = 16, 8_192, 256
LEAST_CHUNK = 1_024        # chunks of small tables are smaller, so that tasks stay even


def rotation(d: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, d]).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def edges_of_blocks(d: int) -> list[tuple[int, int]]:
    n = max(1, d // BLOCK_DIMS)
    cut = [d * k // n for k in range(n + 1)]
    return list(zip(cut[:-1], cut[1:]))


def unit_rotated(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)
    y = x / big
    return (y / np.sqrt((y * y).sum(axis=1, keepdims=True))) @ rotation(x.shape[1])


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two (exact) that keeps their squares finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def roots(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Smallest node reachable, for nodes 0..n-1 and links a-b."""
    p = np.arange(n) if parent is None else parent
    while True:
        while True:
            q = p[p]
            if np.array_equal(q, p):
                break
            p = q
        ra, rb = p[a], p[b]
        apart = ra != rb
        if not apart.any():
            return p
        np.minimum.at(p, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])


def links_of_group(x: np.ndarray, y: np.ndarray | None, wx: np.ndarray, wy: np.ndarray | None, block: int, t: float):
    """Links between the rows of x and y (y None: among the rows of x) whose first
    qualifying block is ``block``: weighted link counts and a parent array over
    the rows of x, then y."""
    x, y = scaled(x), None if y is None else scaled(y)
    d = x.shape[1]
    parts = edges_of_blocks(d)
    budget = [(2 - 2 * t) * (hi - lo) / d + 1e-9 for lo, hi in parts]
    rx = unit_rotated(x)
    ry = rx if y is None else unit_rotated(y)
    yy, wyy = (x, wx) if y is None else (y, wy)
    lo, hi = parts[block]
    ax, ay = rx[:, lo:hi].astype(np.float32), ry[:, lo:hi].astype(np.float32)
    left = np.hstack([-2 * ax, (ax * ax).sum(1, keepdims=True), np.ones((len(ax), 1), np.float32)])
    right = np.hstack([ay, np.ones((len(ay), 1), np.float32), (ay * ay).sum(1, keepdims=True)]).T.copy()
    base = 0 if y is None else len(x)
    n = len(x) + (0 if y is None else len(y))
    count, parent = np.zeros(n, dtype=np.int64), np.arange(n)
    for a in range(0, len(x), ROWS_AT_ONCE):
        b0 = a if y is None else 0                       # pairs above the diagonal only
        near = left[a:a + ROWS_AT_ONCE] @ right[:, b0:] <= budget[block] + 1e-4
        i, j = np.nonzero(near)
        i, j = i + a, j + b0
        if y is None:
            i, j = i[j > i], j[j > i]
        for s in range(0, len(i), 50_000):               # bounded verification
            p, q = i[s:s + 50_000], j[s:s + 50_000]
            u, v = x[p], yy[q]
            cos = (u * v).sum(1) / (np.sqrt((u * u).sum(1)) * np.sqrt((v * v).sum(1)))
            p, q = p[cos >= t], q[cos >= t]
            gap = (rx[p] - ry[q]) ** 2
            first = gap[:, lo:hi].sum(1) <= budget[block]
            for e in range(block):
                first &= gap[:, parts[e][0]:parts[e][1]].sum(1) > budget[e]
            p, q = p[first], q[first]
            np.add.at(count, p, wyy[q])
            np.add.at(count, q + base, wx[p])
            parent = roots(n, p, q + base, parent)
    return count, parent


def near_duplicates(df: DataFrame, cosine: float = 0.95, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """Per row vec_id, n_links, component_id, kept."""
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be in (0, 1]")
    spark = df.sparkSession
    v = F.col(vector_col)
    fine = (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists(v, lambda x: x != 0) & F.col(id_col).isNotNull())
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"),
                     F.when(fine, F.transform(v, lambda x: x + F.lit(0.0).cast(_element(df, vector_col)))).alias("v"))
    path = scratch_path(spark, "vectors")
    (rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
     .write.parquet(path))
    reps = spark.read.parquet(path)
    chunk_rows = max(1, min(CHUNK, max(LEAST_CHUNK, reps.count() // 8)))

    def cells(batches):
        for batch in batches:
            reps, vec = batch_column(batch, "rep"), batch_column(batch, "v")
            if not len(reps):
                continue
            off = vec.offsets.to_numpy()
            flat = vec.values.to_numpy(zero_copy_only=False).astype(np.float64)
            dims = np.diff(off)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.stack([flat[off[k]:off[k + 1]] for k in at])
                rot = unit_rotated(x)
                parts = edges_of_blocks(int(d))
                take = pa.array(at)
                for b, (lo, hi) in enumerate(parts):
                    width = math.sqrt((2 - 2 * cosine) * (hi - lo) / d + 2e-9) * 1.0001
                    yield pa.RecordBatch.from_arrays(
                        [reps.take(take), batch_column(batch, "copies").take(take), vec.take(take),
                         pa.array(np.full(len(at), d), pa.int32()), pa.array(np.full(len(at), b), pa.int32()),
                         pa.array(np.floor(rot[:, lo] / width).astype(np.int32))],
                        names=["rep", "copies", "v", "dim", "block", "cell"])

    kind = reps.schema["v"].dataType.simpleString()
    placed = reps.mapInArrow(cells, f"rep long, copies long, v {kind}, dim int, block int, cell int")
    at = ["dim", "block", "cell"]
    # chunks per cell; the number of cells is bounded by the threshold and the dimensions
    sizes = placed.groupBy(*at).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(*at, F.ceil(F.col("n") / chunk_rows).cast("int").alias("k"))
    path2 = scratch_path(spark, "cells")
    sizes.write.parquet(path2)
    sizes = spark.read.parquet(path2)

    def beside(step, name):
        return sizes.select("dim", "block", (F.col("cell") - step).alias("cell"), F.col("k").alias(name))

    k = (sizes.join(beside(1, "k_next"), at, "left").join(beside(-1, "k_last"), at, "left").na.fill(0))
    chunk = F.pmod(F.xxhash64("rep"), F.col("k")).cast("int")
    unit = placed.join(k, at).withColumn("chunk", chunk)

    def others(count):
        return F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))

    def group(of, first, second, side):
        return F.struct(of.alias("cell"), first.cast("int").alias("first"), second.cast("int").alias("second"),
                        side.cast("int").alias("side"))

    own = F.transform(others("k"), lambda o: group(F.col("cell") * 2, F.least(F.col("chunk"), o),
                                                   F.greatest(F.col("chunk"), o), (F.col("chunk") > o)))
    nxt = F.transform(others("k_next"), lambda o: group(F.col("cell") * 2 + 1, F.col("chunk"), o, F.lit(0)))
    lst = F.transform(others("k_last"), lambda o: group(F.col("cell") * 2 - 1, o, F.col("chunk"), F.lit(1)))
    dealt = unit.select("rep", "copies", "v", "dim", "block", F.explode(F.concat(own, nxt, lst)).alias("g"))
    dealt = dealt.select("rep", "copies", "v", "dim", "block", "g.*")

    def run(t: pa.Table) -> pa.Table:
        block = t["block"][0].as_py()
        rep, w = t["rep"].to_numpy(), t["copies"].to_numpy()
        side = t["side"].to_numpy()
        x = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rep), -1)
        same = t["cell"][0].as_py() % 2 == 0 and t["first"][0].as_py() == t["second"][0].as_py()
        if same:
            order, args = np.arange(len(rep)), (x, None, w, None)
        else:
            l, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            order, args = np.concatenate([l, r]), (x[l], x[r], w[l], w[r])
            if not len(l) or not len(r):
                order = order[:0]
        if not len(order):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        count, parent = links_of_group(*args, block, cosine)
        rep = rep[order]
        hit = count > 0
        return pa.table({"a": pa.array(rep[hit]), "b": pa.array(rep[parent][hit]), "n": pa.array(count[hit])})

    path3 = scratch_path(spark, "links")
    (dealt.groupBy("dim", "block", "cell", "first", "second")
     .applyInArrow(run, "a long, b long, n long").write.parquet(path3))
    links = spark.read.parquet(path3)
    comp = components(links)
    per = links.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    info = (reps.select("v", "rep", "copies").join(per, "rep", "left")
            .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
            .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("component", "rep").alias("component_id")))
    out = rows.join(info, "v", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))


def _element(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.elementType.simpleString()
