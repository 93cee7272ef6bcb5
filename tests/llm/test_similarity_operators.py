"""Joins and searches against brute force, with small thresholds of the bounds
so that every way through the code is taken."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import shingle_join, topk, vector_dedup
from tessera.llm.graph import components
from tessera.llm.shingles import shingle_sets, set_id

from llm_fixtures import shipped  # noqa: F401


def union_find(edges, nodes):
    p = {x: x for x in nodes}

    def find(x):
        while p[x] != x:
            x = p[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components_of_paths_stars_and_loops(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5), (2000, 2001)]
    edges += [tuple(map(int, rng.integers(3000, 3100, 2))) for _ in range(70)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find(edges, {x for e in edges for x in e})
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def corpus():
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 3))
    boiler = [word() for _ in range(40)]
    texts = []
    for k in range(60):                                   # shared passage, otherwise different
        texts.append([word() for _ in range(int(rng.integers(20, 90)))] + boiler)
    base = [word() for _ in range(120)]
    for k in range(50):                                   # a large group of near copies, as a chain too
        t = list(base)
        for _ in range(int(rng.integers(0, 5))):
            t[int(rng.integers(0, 120))] = word()
        texts.append(t)
    chain = [word() for _ in range(100)]
    for k in range(25):
        texts.append(list(chain))
        chain = chain[6:] + [word() for _ in range(6)]
    for k in range(60):                                   # small sets with small changes
        t = [word() for _ in range(int(rng.integers(1, 14)))]
        texts += [t, t + [word()], t[:-1]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(500 + i, rows[i][1].upper()) for i in range(0, 150, 3)]
    rows += [(900, None), (901, ""), (902, " \n"), (None, rows[3][1]), (None, "alone with no id"), (7, rows[7][1]),
             (903, "é " * 3000), (904, "é " * 3000 + "z")]
    return rows


def check_join(spark, rows):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int").repartition(3)
    sets = [shingles(t) for _, t in rows]
    edges = []
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                edges.append((a, b))
    root = union_find(edges, range(len(rows)))
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[root[k]].append(i)
    want = Counter((i, len(sets[k]), min(ids[root[k]], default=None)) for k, (i, _) in enumerate(rows))
    got = shingle_join.join(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    return df, root, sets


@pytest.mark.parametrize("short,frequent,rounds", [(8, 1 << 20, 3), (2, 1 << 20, 1), (2, 0, 0)])
def test_shingle_join_matches_brute_force(spark, monkeypatch, short, frequent, rounds):
    monkeypatch.setattr(shingle_join, "SHORT", short)
    monkeypatch.setattr(shingle_join, "MAX_FREQUENT", frequent)
    monkeypatch.setattr(shingle_join, "STAR_ROUNDS", rounds)
    check_join(spark, corpus())


def test_long_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "SHORT", 2)
    monkeypatch.setattr(shingle_join, "BLOCK", 5)
    check_join(spark, corpus())


def test_a_shared_passage_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Texts that share a passage and link with nothing, and near copies that miss
    the similarity: what is verified follows the number of texts."""
    verified = []
    verify = shingle_join._verify

    def counted(pairs, sets, percent):
        verified.append(pairs.count())
        return verify(pairs, sets, percent)

    monkeypatch.setattr(shingle_join, "_verify", counted)
    for kind in (0, 1):
        counts = []
        for n in (250, 1000):
            rng = np.random.default_rng(n)
            passage = [f"p{k}" for k in range(120)]
            texts = []
            for i in range(n):
                if kind == 0:
                    t = passage + [f"o{i}x{k}" for k in range(int(rng.integers(24, 60)))]
                else:
                    t = [f"e{i}x{k}" if rng.random() < 0.045 else w for k, w in enumerate(passage)]
                texts.append((i, " ".join(t)))
            verified.clear()
            links = shingle_join.join(spark.createDataFrame(texts, "doc_id long, text string")).collect()
            counts.append(sum(verified))
            assert len(links) == n
        assert counts[1] < 8 * counts[0] + 1000


def test_frequent_shingles_come_last_whatever_their_hash(spark, monkeypatch):
    import pyarrow as pa
    orders, init = [], shingle_join.GlobalOrder.__init__
    monkeypatch.setattr(shingle_join.GlobalOrder, "__init__", lambda self, *a: orders.append(self) or init(self, *a))
    passage = " ".join(f"p{k}" for k in range(120))
    texts = [(i, passage + " " + " ".join(f"o{i}x{k}" for k in range(60))) for i in range(20)]
    assert len({r.component_id for r in
                shingle_join.join(spark.createDataFrame(texts, "doc_id long, text string")).collect()}) == 20
    shared, *whole = shingle_sets(pa.array([passage, *(t for _, t in texts)]))
    assert (orders[0].of(shared) == 4).all()                  # 16 to 31 texts hold them
    for h in whole:
        first, cls = orders[0].prefix(h, len(h) - shingle_join.needed(len(h), 75) + 1)
        assert not cls.any() and not np.isin(first, shared).any()


def test_sketches_refuse_no_true_pair():
    rng = np.random.default_rng(8)
    for _ in range(300):
        n = int(rng.integers(1, 900))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = a.copy()
        b[:int(rng.integers(0, n))] = rng.integers(0, 1 << 63)
        b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, int(rng.integers(0, 99)), dtype=np.uint64)]))
        a = np.unique(a)
        only = len(np.setxor1d(a, b))
        apart = int(np.bitwise_count((shingle_join.sketch(a) ^ shingle_join.sketch(b)).view(np.uint64)).sum())
        assert apart <= only


def test_keep_one_of_each_group(spark):
    rows = corpus()
    df, root, sets = check_join(spark, rows)
    kept = shingle_join.keep_one(df)
    assert kept.columns == df.columns
    got = Counter(r.text for r in kept.collect())
    groups = {root[k] for k in range(len(rows)) if sets[k]}
    assert sum(n for t, n in got.items() if shingles(t)) == len(groups)
    assert sum(n for t, n in got.items() if not shingles(t)) == sum(not s for s in sets)


def test_shingle_join_of_an_empty_table(spark):
    e = spark.createDataFrame([], "doc_id long, text string")
    assert shingle_join.join(e).collect() == [] and shingle_join.keep_one(e).collect() == []


def test_shingles_over_segments(monkeypatch):
    import pyarrow as pa

    from tessera.llm import shingles as s
    texts = ["One two\tthree  four FIVE six é ü", "x" * 100 + " y z a b c", None, "", " ", "one two three four five six é ü"]
    whole = shingle_sets(pa.array(texts))
    monkeypatch.setattr(s, "SEGMENT", 16)
    parts = shingle_sets(pa.array(texts))
    assert [list(a) for a in whole] == [list(a) for a in parts]
    assert [len(a) for a in whole] == [len(shingles(t)) for t in texts]
    assert set_id(whole[0]) == set_id(whole[5]) != set_id(whole[1])


def vectors(dim=32, n=400):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, dim))
    for k in range(0, 120, 2):
        x[k + 1] = x[k] + rng.normal(size=dim) * rng.uniform(0, 0.5)
    x[200:260] = x[200] + rng.normal(size=(60, dim)) * 0.15
    x[300:330] = x[300]
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * dim), (1003, [float("nan")] + [1.0] * (dim - 1)),
             (1004, [float("inf")] * dim), (1005, [None] + [1.0] * (dim - 1)), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]),
             (None, rows[0][1]), (3, rows[3][1]), (1008, [1e200 * v for v in rows[5][1]])]
    return rows


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("chunk", [8192, 40])
def test_vector_links_match_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(vector_dedup, "CHUNK", chunk)
    monkeypatch.setattr(vector_dedup, "BLOCK_DIMS", 8)
    rows = vectors()
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, kept int").repartition(3)
    unit = [np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if usable(v) and i is not None
            else None for i, v in rows]
    edges = [(a, b) for a in range(len(rows)) for b in range(a) if unit[a] is not None and unit[b] is not None
             and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    n = Counter(x for e in edges for x in e)
    ids = [(rows[a][0], rows[b][0]) for a, b in edges]
    comp = union_find(ids, {i for i, _ in rows if i is not None})
    want = Counter((i, n[k], comp.get(i), comp.get(i) == i if i is not None else False) for k, (i, _) in enumerate(rows))
    got = vector_dedup.near_duplicates(df).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want


@pytest.mark.parametrize("block,sizes", [(4096, (512, 16_384)), (32, (7, 100))])
def test_top_k_matches_brute_force(spark, monkeypatch, block, sizes):
    monkeypatch.setattr(topk, "LIST_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_CHUNK", sizes[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", sizes[1])
    rows = [r for r in vectors() if r[0] != 1008]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    fine = [(i, tuple(np.floor(64 * np.array(v)).astype(int))) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for at, (q, u) in enumerate(fine):
        if q % 20 == 0:
            best = sorted((-int(np.dot(u, v)), i) for n, (i, v) in enumerate(fine) if n != at and len(v) == len(u))[:20]
            want.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    got = topk.search(df).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


@pytest.mark.parametrize("block", [4096, 32, 20])
def test_top_k_of_ids_with_several_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "LIST_BLOCK", block)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8)) for i in range(90)]
    rows += [(i % 7 * 20, 5 * rng.normal(size=8)) for i in range(70)]       # queries with many long vectors
    rows += [(31, rows[31][1] * 2), (32, rows[32][1] + 1), (20, rows[20][1])]
    rows += [rows[20]] * 2 + [rows[33]] * 25                                # a query and a candidate with copies
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    fine = [(i, tuple(np.floor(64 * v).astype(int))) for i, v in rows]
    want = Counter()
    for at, (q, u) in enumerate(fine):
        if q % 20 == 0:
            best = sorted((-int(np.dot(u, v)), i) for n, (i, v) in enumerate(fine) if n != at)[:20]
            want.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    got = topk.search(df).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


def test_bounds_with_large_integers():
    rng = np.random.default_rng(3)
    for top in (10, 10 ** 6, 10 ** 12):
        x = rng.integers(-top, top, size=(50, 6))
        i, vec, s, _ = topk.best(x[:5], np.arange(5), x, np.arange(50), 4)
        for q in range(5):
            exact = sorted((-int(sum(int(a) * int(b) for a, b in zip(x[q], x[j]))), j) for j in range(50) if j != q)[:4]
            assert [(int(-c), int(v)) for c, v in zip(s[i == q], vec[i == q])] == exact


def test_empty_vector_tables(spark):
    e = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_dedup.near_duplicates(e).collect() == [] and topk.search(e).collect() == []
