"""Resampling, conversation repair and line dedup against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import conversations, line_dedup, resample
from tessera.llm.queries import ORACLES, QUERIES

from llm_fixtures import SF, docs, documents, shipped  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(want.fetchall())


# resampling

def features(text, most=2):
    words = WORD.findall(lower(text))
    return words, [" ".join(words[i:i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def brute_resample(rows, target, most, buckets, min_words, percent, seed):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(zlib.crc32(f.encode()) % buckets for f in features(text, most)[1])
    for text in target:
        t.update(zlib.crc32(f.encode()) % buckets for f in features(text, most)[1])
    total, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets))))
            for b in range(buckets)]
    out = []
    for i, text in rows:
        words, fs = features(text, most)
        w = sum(gain[zlib.crc32(f.encode()) % buckets] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words), len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[:percent * len(able) // 100]
    ranks = defaultdict(list)
    for k, r in enumerate(drawn):
        ranks[r].append(k + 1)
    return Counter((r[0], r[2], r[3], r[4]) for r in out), {k: (r[0], r[4]) for k, r in enumerate(drawn, 1)}


@pytest.mark.parametrize("most, buckets, percent", [(2, 10_000, 25), (1, 50, 100), (4, 70_000, 10)])
def test_resample_matches_brute_force(spark, docs, documents, most, buckets, percent):
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()] + [None, ""]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(docs, bench, most=most, buckets=buckets, percent=percent, keep=("source", "score")).collect()
    want, drawn = brute_resample([(i, t) for i, t, _ in documents], target, most, buckets, 20, percent, 7)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == want
    assert {r["rank"]: (r.doc_id, r.score) for r in got if r["rank"]} == drawn
    assert {r.doc_score for r in got} == {"x"} and {r.source for r in got} == {d[2] for d in documents}


def test_resample_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(none, docs.select("text")).collect() == []
    rows = resample.resample(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"),
                             none.select("text"), min_words=0, percent=50).collect()
    assert {(r.doc_id, r.n_features) for r in rows} == {(1, 3), (2, 0)} and sorted(r["rank"] or 0 for r in rows) == [0, 1]


def test_words_of_long_texts_keep_their_offsets(monkeypatch):
    text = "abc, déf-1 x" * 50 + "y" * 300
    monkeypatch.setattr(resample, "PIECE", 16)
    spans = [x for part in resample.word_spans(text) for x in part]
    assert spans == [(m.group(), m.span()) for m in WORD.finditer(text)]


def test_shifted_crc():
    rng = random.Random(3)
    shift = resample.Shift()
    a = [bytes(rng.randrange(256) for _ in range(rng.randrange(90))) for _ in range(200)]
    b = [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 200))) for _ in range(200)]
    crc = np.array([zlib.crc32(x) for x in a], dtype=np.uint32)
    tail = np.array([zlib.crc32(x) for x in b], dtype=np.uint32)
    got = shift.move(crc, np.array([len(x) for x in b])) ^ tail
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


# conversations

def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_edits(rows):
    """Least (cost, audit) from the end; rows are (role, fault)."""
    inf = (10 ** 9, "")
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {q: (0, "") if q in ("", "a") else inf for q in turn}

    def insert(best):
        for _ in range(4):
            best = {q: min(v, (best[turn[q]][0] + 2, "I" + best[turn[q]][1])) for q, v in best.items()}
        return best

    best = insert(best)
    for role, fault in reversed(rows):
        new = {}
        for q in turn:
            ways = [(best[q][0] + 3, "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                cut, t = int(fault == "truncated"), turn[q]
                after = {role[:1]} & ({"s", "u"} if q == "" else {t})
                ways += [(best[x][0] + cut, "K" + best[x][1]) for x in after]
                ways.append((best[t][0] + 2 + cut, "R" + best[t][1]))
            new[q] = min(ways)
        best = insert(new)
    return best[""]


def brute_repair(rows):
    convs = {r[0] for r in rows}
    by = defaultdict(list)
    for r in brute_damage(rows):
        by[r[0]].append(r[1:])
    out = {}
    for c in convs:
        rs = sorted(by[c], key=lambda r: (r[0] is not None, r[0] or 0))
        seen, faults = set(), []
        for _, role, text in rs:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen
                          else "truncated" if body[-1] not in ".!?" else "none")
            seen.add((role, text))
        cost, audit = brute_edits([(r[1], f) for r, f in zip(rs, faults)])
        state, lines, at = "", [], iter(rs)
        for mark in audit:
            nxt = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            name = {"u": "user", "a": "assistant"}[nxt]
            if mark == "I":
                lines.append(name + ":")
                state = nxt
                continue
            _, role, text = next(at)
            if mark == "D":
                continue
            lines.append((role if mark == "K" else name) + ":" + text)
            state = "s" if mark == "K" and role[0] == "s" else nxt
        turns = [r[0] for r in rs if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = Counter(faults)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        out[c] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversation_rows():
    rng, rows = random.Random(5), []
    for c in range(150):
        for t in range(rng.choice([1, 2, 5, 9, 30])):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
            text = rng.choice([f"w{t}.", f"w{t}", "same!", "same!", " \t", "", None, "ok?  \n", "x. ", "é. "])
            rows.append((c, t * rng.choice([1, 1, 2]) + 100 * t, role, text))
    rows += [(900, None, "user", "a."), (900, 1, "assistant", "b."), (None, 0, "user", "n."), (None, None, "user", "m"),
             (901, None, None, None)]
    rows += [(902, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", "c d", f"{t}.", f"{t}"])) for t in range(400)]
    return rows


def check_conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.selectExpr("*", "'x' AS kind", "1 AS code", "2 AS cost")
    damaged = conversations.damage(df)
    got = {r[0]: tuple(r[1:]) for r in conversations.repair(damaged).collect()}
    want = brute_repair(rows)
    assert got == want
    parts = defaultdict(list)
    for r in conversations.repaired_rows(damaged).collect():
        parts[r.conv_id].append((r.place, f"{r.role}:{r.text}", r.edit))
    for c, w in want.items():
        mine = sorted(parts[c])
        assert [p for p, _, _ in mine] == list(range(len(mine)))
        assert "".join(e for _, _, e in mine) == w[6].replace("D", "")
        assert hashlib.sha256("\n".join(x for _, x, _ in mine).encode()).hexdigest() == w[7]


def test_repair_matches_brute_force(spark):
    check_conversations(spark, conversation_rows())


def test_search_over_segments(monkeypatch):
    rng = random.Random(11)
    names = {0: "x", 1: "user", 2: "assistant", 3: "system"}
    faults = {0: "none", 1: "truncated", 2: "blank", 3: "duplicate"}
    for segment in (1, 2, 3, 7, 64):
        monkeypatch.setattr(conversations, "SEGMENT", segment)
        for _ in range(300):
            codes = bytes(rng.choice([0, 1, 1, 2, 2, 3]) + 4 * rng.choice([0, 0, 0, 1, 2, 3])
                          for _ in range(rng.randrange(0, 14)))
            assert conversations.cheapest(codes) == brute_edits([(names[c & 3], faults[c >> 2]) for c in codes])


def test_repair_of_the_table_and_of_nothing(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op12_conversation_repair"](spark, SF).collect()}
    assert got == brute_repair(rows)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair(conversations.damage(none)).collect() == []


# lines

def brute_lines(rows, index=None, min_docs=3, min_chars=20):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    held = defaultdict(set)
    for i, t in (rows if index is None else index):
        for line in (t or "").split("\n"):
            held[key(line)].add(i)
    bad = {k: max(d, key=lambda i: (i is not None, i)) for k, d in held.items()
           if len(k) >= min_chars and len(d) >= min_docs}
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in bad or bad[key(x)] == i]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def line_rows():
    rng = random.Random(9)
    pool = [f"  Common Line number {k} of the site\t" for k in range(8)] + ["short line", "", "ÄÖ" * 9, "ÄÖ" * 10,
                                                                          "common LINE number 3 of the site"]
    rows = [(i, "\n".join(rng.choice(pool + [f"own line of document {i}, {rng.random()}"]) for _ in range(rng.randrange(9))))
            for i in range(60)]
    rows += [(7, pool[0] + "\n" + pool[1]), (7, pool[0]), (None, pool[0] + "\nx"), (61, None), (62, ""), (63, "a\r\n\x0b\n"),
             (64, (pool[2] + "\n") * 3000), (65, "no id column clash\n" + pool[4])]
    return rows


def lines_frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return df.selectExpr("*", "'x' AS key", "1 AS id", "2 AS kept_text", "3 AS shard", "4 AS `a b`")


def results(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect())


@pytest.mark.parametrize("shards", [None, 5])
def test_line_dedup_matches_brute_force(spark, shards):
    rows = line_rows()
    df = lines_frame(spark, rows)
    index = line_dedup.LineIndex(spark, shards=shards)
    index.insert(df)
    out = index.dedup(df)
    assert results(out) == brute_lines(rows) and {"key", "id", "a b"} <= set(out.columns)


def test_insertions_and_deletions_are_reversible(spark):
    rows = line_rows()
    index = line_dedup.LineIndex(spark, shards=3)
    first, second = rows[:30], rows[30:]
    index.insert(lines_frame(spark, first))
    assert results(index.dedup(lines_frame(spark, first))) == brute_lines(first)
    index.insert(lines_frame(spark, second))
    assert results(index.dedup(lines_frame(spark, rows))) == brute_lines(rows)
    gone = {i for i, _ in second} | {3, 4, None}
    index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    left = [r for r in rows if r[0] not in gone]
    assert results(index.dedup(lines_frame(spark, rows))) == brute_lines(rows, left)
    index.insert(lines_frame(spark, [r for r in rows if r[0] in gone]))
    assert results(index.dedup(lines_frame(spark, rows))) == brute_lines(rows)


def test_line_index_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    index = line_dedup.LineIndex(spark)
    some = spark.createDataFrame([(1, "x" * 30)], "doc_id long, text string")
    assert results(index.dedup(some)) == Counter({(1, 1, 0, "x" * 30): 1})
    index.insert(none)
    assert index.dedup(none).collect() == []
    index.delete(some.select("doc_id"))
    assert results(index.dedup(some)) == Counter({(1, 1, 0, "x" * 30): 1})


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    f = line_dedup.CuckooFilter.sized(5000)
    assert f.add(keys) and f.holds(keys).all()
    assert f.holds(rng.integers(0, 1 << 63, (20_000, 2), dtype=np.uint64)).mean() < 0.001
    f = line_dedup.CuckooFilter.load(f.dump())
    f.remove(keys[:2500])
    assert f.holds(keys[2500:]).all() and f.holds(keys[:2500]).mean() < 0.01
    f.remove(keys[2500:])
    assert not f.table.any()
    with pytest.raises(KeyError):
        f.remove(keys[:1])
    small = line_dedup.CuckooFilter.sized(10)
    assert not small.add(keys)


def test_full_filters_are_built_anew(spark):
    rows = [(d, f"line number {k} that many documents hold") for k in range(200) for d in (3 * k, 3 * k + 1, 3 * k + 2)]
    index = line_dedup.LineIndex(spark, shards=1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index.insert(df.where("doc_id < 12"))
    index.insert(df)
    assert index.dedup(df).where("n_dropped > 0").count() == 400
    assert spark.read.parquet(index.filters).select(F.length("filter")).first()[0] >= 2 * 200
