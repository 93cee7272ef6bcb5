"""Matrix / tensor / vector algebra on tables.

Two layouts:

* **row form** ``(key..., x ARRAY<DOUBLE>)`` - one row per matrix row; the
  natural layout for tall-skinny data (millions of rows, tens or hundreds of
  columns). Element-wise ops are one ``zip_with`` after a key join; a product
  with a small right-hand matrix is a per-row expression (no shuffle).
* **cell form** ``(i, j, v)`` (tensors add ``d``) - general sparse/large
  layout; products are joins on the inner index plus a grouped sum with
  map-side partial aggregation.

Shapes are metadata checked before any job is started.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numeric import double_array_lit

# Cells of a right-hand matrix in one broadcast; a larger one goes in several.
SMALL_CELLS = 1_000_000
# Up to this many cells the product stays a JVM expression; above it the
# per-element lambdas (interpreted) cost more than a numpy kernel per batch.
# Both follow the same rules: a NULL element makes the products of its row NULL,
# sums over rows (gram) skip NULL products, and a row of another width raises.
EXPR_CELLS = 64
# Beyond this many outputs AᵀB goes by tiles: no task holds all its sums.
GRAM_CELLS = 4_000_000


# ---------------------------------------------------------------- row form
def _check_same_width(wa: int, wb: int) -> None:
    if wa != wb:
        raise ValueError(f"shape mismatch: {wa} vs {wb} columns")


def rows_elementwise(a: DataFrame, b: DataFrame, keys: Sequence[str], op: str,
                     width_a: int, width_b: int, x: str = "x") -> DataFrame:
    """Element-wise ``a op b`` of two row-form matrices joined on ``keys``."""
    _check_same_width(width_a, width_b)
    fns = {"add": lambda p, q: p + q, "sub": lambda p, q: p - q, "mul": lambda p, q: p * q}
    if op not in fns:
        raise ValueError(f"unknown element-wise op {op!r}")
    j = _paired(a.select(*keys, F.col(x).alias("_v")), b.select(*keys, F.col(x).alias("_v")), list(keys))
    one = F.zip_with(of_width(F.col("_a"), width_a), of_width(F.col("_b"), width_b), fns[op])
    return j.select(*keys, one.alias(x))


def _paired(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _a, _b) from two tables (keys, _v), by one shuffle of both. A key
    that stands twice in one table, or in one of them only, fails the job."""
    none = F.lit(None).cast(a.schema["_v"].dataType)
    both = (a.select(*keys, F.col("_v").alias("_a"), none.alias("_b"), F.lit(1).alias("_na"), F.lit(0).alias("_nb"))
            .unionByName(b.select(*keys, none.alias("_a"), F.col("_v").alias("_b"), F.lit(0).alias("_na"),
                                  F.lit(1).alias("_nb"))))
    one = both.groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"), F.sum("_na").alias("_na"),
                                  F.sum("_nb").alias("_nb"))
    bad = F.raise_error(F.when((F.col("_na") > 1) | (F.col("_nb") > 1), F.lit("shape mismatch: a key stands twice"))
                        .otherwise(F.lit("shape mismatch: a row or cell is missing on one side")))
    fit = (F.col("_na") == 1) & (F.col("_nb") == 1)
    return one.select(*keys, *[F.when(fit, F.col(c)).otherwise(bad.cast(a.schema["_v"].dataType)).alias(c)
                               for c in ("_a", "_b")])


def of_width(x: Column, width: int) -> Column:
    """The array, if it is there and has the declared width; else the job fails."""
    return F.when(F.size(x) == width, x).otherwise(F.raise_error(F.lit(
        "shape mismatch: a row is missing on one side or has another width")).cast("array<double>"))


def rows_scale(a: DataFrame, s: float, x: str = "x") -> DataFrame:
    return a.withColumn(x, F.transform(x, lambda v: v * F.lit(float(s))))


def rows_add_bias(a: DataFrame, bias: Sequence[float], x: str = "x") -> DataFrame:
    """x[j] + b[j] (a per-column bias, inlined as a literal array)."""
    return a.withColumn(x, F.zip_with(F.col(x), double_array_lit(bias), lambda p, q: p + q))


def dot(u: Column, v: Column) -> Column:
    return F.aggregate(F.zip_with(u, v, lambda p, q: p * q), F.lit(0.0), lambda acc, t: acc + t)


def matvec_expr(x: Column, w: np.ndarray) -> Column:
    """Row vector x (length k) times a small k x m matrix -> length-m array,
    as one JVM expression (columns of w inlined as literal arrays)."""
    k, m = w.shape
    if k * m > SMALL_CELLS:
        raise ValueError("right-hand matrix too large to inline; use cells_matmul")
    cols = [double_array_lit(w[:, c]) for c in range(m)]
    return F.array(*[dot(x, col) for col in cols])


def rows_matmul_small(a: DataFrame, w: np.ndarray, width_a: int, x: str = "x") -> DataFrame:
    """Tall row-form A (n x k) times small W (k x m): narrow, shuffle-free.

    Small W: one JVM expression per output column. Larger W: ``mapInArrow`` with
    ``x @ W`` per Arrow batch, W broadcast in blocks of ``SMALL_CELLS`` cells."""
    if width_a != w.shape[0]:
        raise ValueError(f"shape mismatch: A has {width_a} columns, W has {w.shape[0]} rows")
    if w.size <= EXPR_CELLS:
        checked = F.when(F.col(x).isNull() | (F.size(x) == width_a), F.col(x)).otherwise(
            F.raise_error(F.lit("shape mismatch: a row has another width")).cast("array<double>"))
        return a.withColumn(x, checked).withColumn(x, matvec_expr(F.col(x), w))
    import pyarrow as pa
    step = max(1, SMALL_CELLS // max(1, w.shape[0]))
    parts = [a.sparkSession.sparkContext.broadcast(np.asarray(w[:, k:k + step], dtype=float))
             for k in range(0, w.shape[1], step)]
    m = w.shape[1]
    names = a.columns
    schema = a.select(*[c for c in names if c != x]).schema
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    out_schema = (out_schema + ", " if out_schema else "") + f"`{x}` array<double>"

    def run(batches):
        for b in batches:
            xs, unknown = rows_with_nulls(b.column(x), width_a)
            ys = np.hstack([xs @ p.value for p in parts]) if len(xs) else np.zeros((0, m))
            values = pa.array(ys.ravel(), mask=np.repeat(unknown, m))
            offsets = pa.array(np.arange(0, len(xs) * m + 1, m, dtype=np.int32))
            cols = [b.column(f.name) for f in schema.fields] + [pa.ListArray.from_arrays(offsets, values)]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields] + [x])

    src = a.select(*[c for c in names if c != x], F.col(x).cast("array<double>").alias(x))
    return src.mapInArrow(run, out_schema)


def rows_with_nulls(col, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrow list<double> -> (n, width) array and whether a row holds a NULL
    (NULLs, and rows that are NULL themselves, are 0 in the array)."""
    elements, unknown = elements_with_nulls(col, width)
    return elements, unknown.any(axis=1)


def elements_with_nulls(col, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrow list<double> -> (n, width) array and the mask of its NULLs."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    out, unknown = np.zeros((n, width)), np.ones((n, width), dtype=bool)
    there = ~col.is_null().to_numpy(zero_copy_only=False) if n else np.zeros(0, dtype=bool)
    sizes = pc.fill_null(pc.list_value_length(col), width).to_numpy(zero_copy_only=False) if n else np.zeros(0)
    if (sizes != width).any():
        raise ValueError("shape mismatch: a row has another width")
    flat = col.flatten()
    out[there] = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False).reshape(-1, width)
    unknown[there] = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out, unknown


def gram_cells(df: DataFrame, width_a: int, width_b: int, x: str = "x", y: str = "y") -> DataFrame:
    """AᵀB of two tall row-form matrices stored on the same rows (columns
    ``x`` and ``y``) as cells ``(i, j, v)``.

    Up to ``EXPR_CELLS`` outputs: one aggregate of width_a*width_b sums with
    map-side partial aggregation, exploded from its single row. Larger: every
    task adds ``XᵀY`` of its Arrow batches with numpy and emits one partial row
    per cell; a grouped sum (output the size of AᵀB) finishes it. Beyond
    ``GRAM_CELLS`` outputs: ``tiles.gram_tiles``."""
    if width_a * width_b > GRAM_CELLS:
        from tessera.operators.tiles import gram_tiles
        return gram_tiles(df, width_a, width_b, x, y)
    if width_a * width_b > EXPR_CELLS:
        return _gram_cells_numpy(df, width_a, width_b, x, y)
    wide = F.lit("shape mismatch: a row has another width")
    fits = (F.coalesce(F.size(x) == width_a, F.lit(True)) & F.coalesce(F.size(y) == width_b, F.lit(True)))
    df = df.select(F.when(fits, F.col(x)).otherwise(F.raise_error(wide).cast("array<double>")).alias(x), y)
    aggs = [F.sum(F.get(F.col(x), F.lit(i)) * F.get(F.col(y), F.lit(j))).alias(f"g{i}_{j}")
            for i in range(width_a) for j in range(width_b)]
    one = df.agg(*aggs)
    cells = [F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j"),
                      F.col(f"g{i}_{j}").alias("v"))
             for i in range(width_a) for j in range(width_b)]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _gram_cells_numpy(df: DataFrame, wa: int, wb: int, x: str, y: str) -> DataFrame:
    import pyarrow as pa
    src = df.select(F.col(x).cast("array<double>").alias("x"), F.col(y).cast("array<double>").alias("y"))

    def run(batches):
        total, known = np.zeros((wa, wb)), np.zeros((wa, wb), dtype=np.int64)
        for b in batches:
            (xs, nx), (ys, ny) = elements_with_nulls(b.column("x"), wa), elements_with_nulls(b.column("y"), wb)
            if not nx.any() and not ny.any():
                total += xs.T @ ys
                known += len(xs)
                continue
            for i in range(wa):                          # a NULL product adds nothing, not 0 times infinity
                both = ~nx[:, i:i + 1] & ~ny
                total[i] += np.where(both, xs[:, i:i + 1] * ys, 0.0).sum(axis=0)
                known[i] += both.sum(axis=0)
        ii, jj = np.divmod(np.arange(wa * wb, dtype=np.int64), wb)
        yield pa.RecordBatch.from_arrays([pa.array(ii), pa.array(jj), pa.array(total.ravel(), mask=known.ravel() == 0)],
                                         names=["i", "j", "v"])

    return src.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))


def rows_gram(df: DataFrame, width_a: int, width_b: int, x: str = "x", y: str = "y") -> np.ndarray:
    """AᵀB as a driver array (width_a x width_b, model-sized)."""
    g = np.zeros((width_a, width_b))
    for r in gram_cells(df, width_a, width_b, x, y).collect():
        g[r["i"], r["j"]] = r["v"] or 0.0
    return g


def rows_to_cells(a: DataFrame, key: str, x: str = "x") -> DataFrame:
    """Row form -> cell form (i = key, j = position)."""
    return a.select(F.col(key).alias("i"), F.posexplode(x).alias("j", "v")) \
        .select("i", F.col("j").cast("long").alias("j"), "v")


# ---------------------------------------------------------------- cell form
def fill_cells(spark: SparkSession, rows: int, cols: int, value: float = 0.0,
               depth: int | None = None, partitions: int | None = None) -> DataFrame:
    """rows x cols (x depth) block of one value, generated in parallel."""
    n = rows * cols * (depth or 1)
    r = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(0, n)
    if depth is None:
        return r.select((F.col("id") / cols).cast("long").alias("i"),
                        (F.col("id") % cols).alias("j"), F.lit(float(value)).alias("v"))
    plane = rows * cols
    return r.select((F.col("id") / plane).cast("long").alias("d"),
                    ((F.col("id") % plane) / cols).cast("long").alias("i"),
                    (F.col("id") % cols).alias("j"), F.lit(float(value)).alias("v"))


def fill_like(df: DataFrame, key: str, cols: int, value: float = 0.0) -> DataFrame:
    """One value in ``cols`` columns for every row of a table, under the row's own key."""
    return df.select(F.col(key).cast("long").alias("i"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cols - 1).cast("long"))).alias("j")) \
        .withColumn("v", F.lit(float(value)))


def cells_elementwise(a: DataFrame, b: DataFrame, op: str, keys: Sequence[str] = ("i", "j")) -> DataFrame:
    """Cells of equal shape; a cell that only one side has, or that one has twice,
    fails the job."""
    fns = {"add": lambda p, q: p + q, "sub": lambda p, q: p - q, "mul": lambda p, q: p * q}
    if op not in fns:
        raise ValueError(f"unknown element-wise op {op!r}")
    j = _paired(a.select(*keys, F.col("v").cast("double").alias("_v")),
                b.select(*keys, F.col("v").cast("double").alias("_v")), list(keys))
    return j.select(*keys, fns[op](F.col("_a"), F.col("_b")).alias("v"))


def cells_scale(a: DataFrame, s: float) -> DataFrame:
    return a.withColumn("v", F.col("v") * F.lit(float(s)))


def cells_transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def cells_rot180(a: DataFrame, rows: int, cols: int) -> DataFrame:
    """(i, j) -> (rows-1-i, cols-1-j), other key columns unchanged."""
    return a.withColumn("i", F.lit(rows - 1) - F.col("i")).withColumn("j", F.lit(cols - 1) - F.col("j"))


def cells_matmul(a: DataFrame, b: DataFrame, b_cells: int) -> DataFrame:
    """Σ_k a[i,k]·b[k,j]: join on k, grouped sum (partial + final).

    ``b_cells`` is the exact cell count of B; B is broadcast only under
    ``SMALL_CELLS`` (a shuffle join on a low-cardinality k would put all of
    A's cells for one k in one task). Above it the join is shuffled on k and
    AQE's skew-join splitting spreads hot k values.
    """
    left = a.select("i", F.col("j").alias("k"), F.col("v").alias("_a"))
    right = b.select(F.col("i").alias("k"), "j", F.col("v").alias("_b"))
    if b_cells <= SMALL_CELLS:
        right = F.broadcast(right)
    return (left.join(right, "k")
            .groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v")))


def flat_index(d: Column, i: Column, j: Column, rows: int, cols: int) -> Column:
    return d * F.lit(rows * cols) + i * F.lit(cols) + j


def unflatten_index(idx: Column, rows: int, cols: int) -> tuple[Column, Column, Column]:
    plane = rows * cols
    return ((idx / plane).cast("long"), ((idx % plane) / cols).cast("long"), idx % cols)


def tensor_cells(df: DataFrame, key: str, x: str, shape: tuple[int, int, int]) -> DataFrame:
    """Flat channel-row-col arrays -> (key, d, i, j, v)."""
    c, h, w = shape
    p = df.select(key, F.posexplode(x).alias("_idx", "v"))
    d, i, j = unflatten_index(F.col("_idx"), h, w)
    return p.select(key, d.alias("d"), i.alias("i"), j.cast("long").alias("j"), "v")


def rot180_array(x: Column, shape: tuple[int, int, int]) -> Column:
    """Rotate every channel of a flat channel-row-col array by 180 degrees."""
    c, h, w = shape
    plane = h * w
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(c - 1)),
                                 lambda d: F.reverse(F.slice(x, d * plane + 1, plane))))


# ---------------------------------------------------------------- parameters
def uniform_from_md5(seed: int, tag: str, idx: Column) -> Column:
    """Reproducible uniform(-0.1, 0.1) from md5(seed:tag:idx) (same in SQL)."""
    h = F.md5(F.concat(F.lit(f"{seed}:{tag}:"), idx.cast("string")))
    u = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return u * F.lit(0.2) - F.lit(0.1)


def init_params(spark: SparkSession, layer: int, rows: int, cols: int, seed: int) -> DataFrame:
    """Weights (rows x cols) and bias (cols) of a dense layer as a parameter
    table ``(layer, param, idx, v)``; seed 0 gives zeros."""
    n = rows * cols
    ids = spark.range(0, n + cols)
    param = F.when(F.col("id") < n, F.lit("w")).otherwise(F.lit("b"))
    idx = F.when(F.col("id") < n, F.col("id")).otherwise(F.col("id") - n)
    v = F.lit(0.0) if seed == 0 else uniform_from_md5(seed, f"{layer}", F.col("id"))
    return ids.select(F.lit(layer).alias("layer"), param.alias("param"), idx.alias("idx"), v.alias("v"))

