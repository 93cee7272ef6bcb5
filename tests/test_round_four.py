"""Sparse tiles and chained optimisation steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import tiles


def cells(spark, m):
    rows = [(int(i), int(j), float(m[i, j])) for i, j in np.argwhere(m != 0)]
    return spark.createDataFrame(rows, "i long, j long, v double").repartition(3)


def test_tiles_take_bytes_by_their_cells(spark):
    m = np.zeros((64, 64))
    m[[0, 5, 40, 63], [1, 30, 2, 63]] = [1.0, -2.0, float("inf"), 4.0]
    t = tiles.to_tiles(cells(spark, m), 64, 64, size=32)
    assert sorted(r[0] for r in t.select(F.length("tile")).collect()) == [12, 12, 24]      # 8 KB each before
    full = tiles.to_tiles(cells(spark, np.ones((32, 32))), 32, 32, size=32)
    assert [r[0] for r in full.select(F.length("tile")).collect()] == [8 * 32 * 32]
    got = {(r.i, r.j): r.v for r in tiles.to_cells(t, 64, 64, size=32).where("v != 0").collect()}
    assert got == {(int(i), int(j)): m[i, j] for i, j in np.argwhere(m != 0)}


@pytest.mark.parametrize("fill", [0.02, 0.3, 1.0])
def test_product_deals_tiles_where_the_other_side_has_some(spark, monkeypatch, fill):
    monkeypatch.setattr(tiles, "GROUP", 2)
    monkeypatch.setattr(tiles, "STRETCH", 3)
    monkeypatch.setattr(tiles, "PRODUCTS", 5)
    rng = np.random.default_rng(4)
    a, b = np.zeros((48, 96)), np.zeros((96, 48))
    for c in range(3):                  # three blocks with nothing in common
        i, k = slice(16 * c, 16 * c + 16), slice(32 * c, 32 * c + 32)
        a[i, k] = rng.integers(1, 9, (16, 32)) * (rng.random((16, 32)) < fill)
        b[k, i] = rng.integers(1, 9, (32, 16)) * (rng.random((32, 16)) < fill)
    seen = []
    real = tiles._multiplied
    monkeypatch.setattr(tiles, "_multiplied", lambda both, *more: seen.append(both) or real(both, *more))
    ta, tb = tiles.to_tiles(cells(spark, a), 48, 96, 8), tiles.to_tiles(cells(spark, b), 96, 48, 8)
    out = tiles.to_cells(tiles.matmul(ta, tb, (48, 96), (96, 48), 8), 48, 48, 8)
    got = np.zeros((48, 48))
    for r in out.collect():
        got[r.i, r.j] += r.v
    assert (got == a @ b).all()
    # each tile to the one group of its block, three times as often before
    assert seen[0].count() <= ta.count() + tb.count()
    assert fill < 1 or seen[0].count() == 48


def test_packed_products_keep_infinite_values(spark):
    a = np.array([[float("inf"), 0.0], [2.0, 0.0]])
    b = np.array([[1.0, 0.0], [0.0, 0.0]])
    big = 16
    out = tiles.cells_matmul_large(cells(spark, a), cells(spark, b), (2, 2), (2, 2), size=big)
    got = {(r.i, r.j): r.v for r in out.collect()}
    assert got[0, 0] == float("inf") and np.isnan(got[0, 1]) and got[1, 0] == 2 and got[1, 1] == 0


def test_small_batches_take_a_job_for_a_stretch(spark, monkeypatch):
    from tessera.operators import train
    from tessera.operators.dataset import Dataset
    from tessera.operators.model import Dense, Sequential
    from tessera.operators.optim import new_optimizer

    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist(), np.eye(3)[i % 3].tolist()) for i in range(203)]
    df = spark.createDataFrame(rows, "row_id long, x array<double>, y array<double>").repartition(3).cache()
    jobs = {"chained": 0, "single": 0}
    chain, single = train.chained_steps, train.gradient_sums

    def counted(kind, real):
        def run(*a, **k):
            jobs[kind] += 1
            return real(*a, **k)
        return run

    monkeypatch.setattr(train, "chained_steps", counted("chained", chain))
    monkeypatch.setattr(train, "gradient_sums", counted("single", single))
    got = []
    for stretch in (64, 1):             # 8 batches a job; a job for each batch
        monkeypatch.setattr(train, "CHAIN_ROWS", stretch)
        model = Sequential((4,), [Dense(5, "tanh", dropout=[0.2]), Dense(3, "softmax")], seed=2)
        opt = new_optimizer("SGD", learning_rate=0.1, momentum=0.9, nesterov=True)
        model, hist = train.fit(model, Dataset(df, [], None, 3), opt, "categorical_crossentropy", "accuracy",
                                epochs=2, batch_size=8, seed=6)
        got.append((model.flat(), [(r.loss, r.metric) for r in hist.orderBy("epoch").collect()], opt.state["v"]))
    assert jobs == {"chained": 2 * 4, "single": 2 * 26}       # 52 jobs of their own before
    for a, b in zip(*got):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)


def test_packing_with_small_slices_and_caches(spark):
    import public_tokenizers

    from tessera.llm import packing
    from tessera.llm.common import ItemTokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    small = ItemTokenizer.load(path, 4096)
    assert small.cache.size == 4096 and ItemTokenizer.load(path).cache.size > 4096
    words = [(i, None if i == 7 else " ".join(f"w{i * k % 97}x{k}." for k in range(i % 40 * 20))) for i in range(60)]
    docs = spark.createDataFrame(words, "doc_id long, text string").coalesce(1)
    got = [sorted(map(tuple, packing.pack_documents(docs, path, **more).collect()))
           for more in ({}, {"slice_bytes": 1000, "cache_bytes": 4096})]
    assert got[0] == got[1] and len({r[0] for r in got[0]}) == 60
