"""Operators on texts against the libraries or brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import licences, mixing, packing, records, rules, sharding, token_counts
from tessera.llm.token_counts import count_after_merges
from tessera.session import scratch_path

from llm_fixtures import SF, docs, documents, shipped  # noqa: F401

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def byte_ids(texts):
    tok = Tokenizer.from_file(BYTE)
    return [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def test_token_counts_match_library(docs, documents):
    tok = Tokenizer.from_file(WORD)
    want = Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids))
                   for i, t, _ in documents)
    got = token_counts.token_counts(docs, WORD, limit=100).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)


def test_merge_order():
    ranks = {("b", "c"): 0, ("a", "b"): 1, ("a", "bc"): 2}
    assert count_after_merges(list("abc"), ranks) == 1
    assert count_after_merges(list("aab"), ranks) == 2
    assert count_after_merges([], ranks) == 0
    assert count_after_merges(list("a" * 9), {("a", "a"): 0, ("aa", "aa"): 1}) == 3


def test_records_round_trip(spark, docs, documents):
    folder = scratch_path(spark, "records-test")
    files = records.write_records(docs, BYTE, folder, end_id=2, partitions=3)
    got = records.read_records(spark, files, folder, with_ids=True).collect()
    ids = {}
    for (i, t, _), x in zip(documents, byte_ids([t for _, t, _ in documents])):
        ids.setdefault(i, []).append(x + [2])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(x), crc(x)) for i, xs in ids.items() for x in xs)
    at = 0
    order = sorted(got, key=lambda r: r.start)
    for r in order:
        assert r.start == at and crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32
        at += r.n_tokens
    known = [r.doc_id for r in order]
    assert [x for x in known if x is None] == known[:2] and known[2:] == sorted(known[2:])


def test_damaged_record_is_found(tmp_path):
    rec = bytearray(records.frame(b"abcdef"))
    assert records.read_frame(__import__("io").BytesIO(bytes(rec))) == b"abcdef"
    for at in (0, 9, 13, len(rec) - 1):
        bad = bytearray(rec)
        bad[at] ^= 1
        with pytest.raises(Exception):
            records.read_frame(__import__("io").BytesIO(bytes(bad)))


def check_pieces(got, docs, cap, segments, end):
    want = Counter()
    for x in docs:
        x = x + end
        want[(len(x), crc(x))] += 1
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        by_seq[r.sequence_id].append(r)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= cap and len(rs) <= segments
    return by_seq


def test_packing_places_every_token_once(docs, documents):
    got = packing.pack_documents(docs, BYTE, end_id=0, max_tokens=256, max_segments=6, with_ids=True).collect()
    ids = byte_ids([t for _, t, _ in documents])
    seqs = check_pieces(got, ids, 256, 6, [0])
    # put the pieces of each id together again (equal rows: as many of each start)
    for i in {d[0] for d in documents}:
        want = sorted([x + [0] for d, x in zip(documents, ids) if d[0] == i])
        mine = [r for r in got if r.doc_id == i]
        assert sum(r.length for r in mine) == sum(map(len, want))
        for r in mine:
            piece = list(np.frombuffer(r.ids, "<u4"))
            assert crc(piece) == r.ids_crc32
            assert any(len(x) == r.doc_tokens and x[r.start:r.start + r.length] == piece for x in want)
    fill = sum(r.length for r in got) / (256 * len(seqs))
    assert fill > 0.97


def test_packing_limits_on_loss_tokens(spark):
    rows = [(i, "word " * (3 + i % 40), i % 30) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt int").coalesce(1)
    got = packing.pack_documents(df, BYTE, end_id=0, max_tokens=128, max_segments=4, max_loss=60,
                                 loss_from_col="prompt").collect()
    loss, tokens = Counter(), Counter()
    for r in got:
        loss[r.sequence_id] += r.loss_tokens
        tokens[r.doc_id] += r.length
        assert r.loss_tokens == max(0, r.start + r.length - max(r.start, rows[r.doc_id][2]))
    assert max(loss.values()) <= 60 and all(tokens[r.doc_id] == r.doc_tokens for r in got) and len(tokens) == 300
    check_pieces(got, [], 128, 4, [])


def brute_words(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_licence_places_match_brute_force(docs, documents):
    got = Counter()
    for r in licences.scan(docs).collect():
        got[(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)] += 1
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        if r.doc_id == -13:
            assert r.labels == "mit" and [p.word for p in r.places] == [3]
    want = Counter()
    for i, t, _ in documents:
        w, places, labels = brute_words(t), [], set()
        for phrase, label in licences.BASE.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k:k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        want[(i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))] += 1
    assert got == want


def brute_templates(text):
    """(label, first word) of each place of a template's first key phrase near
    which all its others stand, and the best share of a template's words there."""
    w, places, best = brute_words(text), [], 0.0
    for label, statement, keys in licences.TEMPLATES:
        t = statement.split()
        starts = []
        for k in keys:
            k = k.split()
            at = next(j for j in range(len(t)) if t[j:j + len(k)] == k)
            starts.append([i - at for i in range(len(w)) if w[i:i + len(k)] == k])
        for s in starts[0]:
            if all(any(abs(s - o) <= licences.TOLERANCE for o in other) for other in starts[1:]):
                places.append((label, max(s, 0)))
                best = max(best, sum(0 <= s + j < len(w) and w[s + j] == x for j, x in enumerate(t)) / len(t))
    return sorted(places), best


GPL_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License."""


def test_licence_templates_match_brute_force_whatever_else_stands(spark, documents):
    statements = [statement for _, statement, _ in licences.TEMPLATES]
    rows = [(i, t) for i, t, _ in documents]
    rows += [(1001, "Any person may use this software free of charge. Released under the MIT license"),
             (1002, "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0. "
                    "Licensed under the GNU General Public License version 3."),
             (1003, " and then ".join(statements)), (1004, " ".join(reversed(statements)) * 3),
             (1005, "mit license"), (1006, "license mit, public domain: free and unencumbered software"),
             (1007, " ".join(licences.vocabulary(licences.TEMPLATES, licences.BASE)) + ". Under the ISC license"),
             (1008, GPL_3), (1009, MIT), (1010, BSD), (1011, APACHE), (1012, "# SPDX-License-Identifier: MIT"),
             (1013, "the Apache License covers nothing here, nor does the MIT License or version 2.0 of it"),
             (1014, GPL_3.replace("either", "either, as you like, the")),
             (1015, GPL_3.replace("either", "either, as you or they may come to like it, the")),
             (1016, "version 2 0 under the apache license"), (1017, (APACHE + MIT + "\n") * 40),
             (1018, "one\u2028" + GPL_3.replace(" ", "\u00a0") + " " + MIT.replace(" ", "\t"))]
    got = Counter()
    for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[(r.doc_id, r.labels, tuple((p.label, p.word) for p in r.places), round(r.score, 9))] += 1
    want, held = Counter(), {}
    for i, t in rows:
        places, best = brute_templates(t)
        base = {b for p, b in licences.BASE.items() if f" {p} " in f" {' '.join(brute_words(t))} "}
        labels = {label for label, _ in places} | base
        held[i] = labels
        want[(i, ",".join(sorted(labels)), tuple(places), round(1.0 if base else best, 9))] += 1
    assert got == want
    assert held[1001] == {"mit"} and "gpl-3" in held[1002] and held[1003] >= {label for label, _, _ in licences.TEMPLATES}
    assert held[1008] == {"gpl", "gpl-3"} and held[1009] == held[1012] == {"mit"} and held[1010] == {"bsd"}
    assert held[1011] == {"apache-2.0"} and held[1017] == {"apache-2.0", "mit"}
    assert "gpl-3" in held[1014] and "gpl-3" not in held[1015]
    assert not held[1005] | held[1006] | held[1013] | held[1016]


def test_licence_plan_is_native_and_narrow(docs):
    plan = licences.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_by_rendezvous(docs, documents):
    got = sharding.shard(docs, [1.0] * 8).collect()
    assert len(got) == len(documents)
    slots = defaultdict(list)
    for r in got:
        assert r.grown_shard in (r.shard, 8)
        u = [(int(hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}:{s}".encode()).hexdigest()[:13], 16), -s)
             for s in range(9)]
        assert (r.shard, r.grown_shard) == (-max(u[:8])[1], -max(u)[1])
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    raw = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in documents)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == raw
    plan = sharding.shard(docs, [1.0] * 8, rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_weighted_shards_get_their_share(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "'' AS text")
    n = {r.shard: r["count"] for r in sharding.shard(df, [1.0, 3.0]).groupBy("shard").count().collect()}
    assert abs(n[1] / 20_000 - 0.75) < 0.02


def brute_targets(sizes, weights):
    """Share by weight, cap, share the excess again."""
    out, left, open_ = [0.0] * len(sizes), 1.5 * sum(sizes), set(range(len(sizes)))
    while True:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > 2 * sizes[i] + 1e-9]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            return out
        for i in over:
            out[i] = 2.0 * sizes[i]
            open_.discard(i)
        left = 1.5 * sum(sizes) - sum(out[i] for i in range(len(sizes)) if i not in open_)


def test_mixture_meets_targets(docs, documents):
    got = mixing.assign(docs).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r.mix_size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and 0 <= r.mix_taken <= 2 * r.mix_size
        size[r.source] += r.mix_size
        taken[r.source] += r.mix_taken
        target[r.source] = r.mix_target
        assert 0 <= r.mix_shard_first < 8 and 0 <= r.mix_shard_again < 8
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    want = brute_targets([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    for s, t in zip(names, want):
        assert target[s] == pytest.approx(t) and abs(taken[s] - t) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.assign(docs.repartition(5)).collect()))
    mixed = mixing.materialise(mixing.assign(docs))
    assert mixed.columns[:len(docs.columns)] == docs.columns
    words = mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    assert {r.source: r.n for r in words} == {s: taken[s] for s in names}


def test_mixture_of_whole_documents(spark):
    import corpus_pipeline

    rng = np.random.default_rng(8)
    rows = [(1, " long  text\n" * 3000, "one"), (2, "a  b\tc " * 50, "two"), (3, " d e\n" * 70, "two"), (4, "", "two")]
    rows += [(10 + i, "w \n x " * int(rng.integers(1, 60)), f"s{i % 5}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts, size = {i: t for i, t, _ in rows}, {i: len(t.split()) for i, t, _ in rows}
    plan = mixing.assign(df).collect()
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.mixture(spark, df, None).collect())
    assert all(texts[i] == t for i, t in got) and max(got.values()) <= 2
    assert any(0 < r.mix_taken % r.mix_size for r in plan if r.mix_size)            # some documents are cut
    times, taken, words, most = Counter(i for i, _ in got.elements()), Counter(), Counter(), Counter()
    for r in plan:
        first = r.mix_first > 0 or not r.mix_size
        assert times[r.doc_id] == first + (2 * r.mix_again > r.mix_size)
        taken[r.source] += r.mix_taken
        words[r.source] += times[r.doc_id] * size[r.doc_id]
        most[r.source] = max(most[r.source], r.mix_size)
    assert all(abs(words[s] - taken[s]) < most[s] for s in taken)


@pytest.mark.parametrize("shards", [8, 3])
def test_partitions_of_the_mixture_hold_one_shard(docs, shards):
    mixed = mixing.materialise(mixing.assign(docs, shards=shards), shards=shards)
    rows = mixed.select(F.spark_partition_id().alias("part"), "mix_shard", "mix_order").collect()
    of = defaultdict(set)
    for r in rows:
        of[r.part].add(r.mix_shard)
    assert all(len(s) == 1 for s in of.values()) and {r.mix_shard for r in rows} == set(range(shards))
    rows.sort(key=lambda r: r.part)
    assert [(r.mix_shard, r.mix_order) for r in rows] == sorted((r.mix_shard, r.mix_order) for r in rows)


def test_splitting_tree_is_exact():
    q = np.array([5, 0, 17, 100, 1])
    out = mixing.split_quotas(q, 7, seed=3)
    assert (out.sum(axis=0) == q).all() and out.sum(axis=1).max() - out.sum(axis=1).min() <= 1 and (out >= 0).all()


def test_rules_learn_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = rules.fit(docs, labels)
    assert 0 < len(model.rules) <= model.rows // rules.ROWS_A_RULE
    out = rules.apply(docs, model).withColumn("out", rules.held_out(F.col("doc_id"))).join(
        labels.select("doc_id", "quality"), "doc_id").where("out")
    right, n, kept = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*"),
                             F.avg(F.when(F.col("quality") == 1, F.col("predicted")))).first()
    assert n > 100 and right > 0.95 and kept > 0.97


def test_rules_on_awkward_rows(docs, documents):
    model = rules.RuleModel(0.5, [rules.Rule({"upper": (0.1, np.inf), "bars": (-np.inf, 0.5)}, -2.0)])
    out = rules.apply(docs, model)
    assert "score" in out.columns and len(out.columns) == len(docs.columns) + 1
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.collect())
    assert out.count() == len(documents)


def test_compiled_rules_match_numpy(spark, docs):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    model = rules.fit(table, spark.read.parquet(f"{folder}/labels.parquet"))
    for df in (table, docs):
        stats = rules.statistics(F.col("text"))
        got = rules.apply(df.withColumns(stats), model).select(*stats, "score", "predicted").collect()
        x = np.array([[r[k] for k in stats] for r in got])
        z = np.full(len(x), model.intercept)
        for rule in model.rules:
            z += rule.weight * rules.covers(rule, x, list(stats))
        want = 1 / (1 + np.exp(-z))
        assert np.allclose([r.score for r in got], want, rtol=1e-12)
        assert [r.predicted for r in got] == [int(w >= 0.5) for w in want]


def test_penalty_is_chosen_and_kept():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 1.2) | (x[:, 2] < -1)).astype(float)
    model = rules.fit_rules(x, y, list("abcd"))
    z = model.intercept + sum(r.weight * rules.covers(r, x, list("abcd")) for r in model.rules)
    assert ((z >= 0) == (y > 0)).mean() > 0.97 and len(model.rules) <= 60
    noise = rules.fit_rules(x, (rng.random(600) < 0.5).astype(float), list("abcd"))
    assert abs(np.mean([r.weight for r in noise.rules] or [0])) < 0.5


def test_rules_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.apply(docs, rules.fit(docs, none)).where('score != 0.5').isEmpty()
    one = spark.createDataFrame([(-2, 1), (-3, None)], "doc_id long, quality int")
    assert not rules.fit(docs, one).rules


def test_empty_tables(spark):
    e = spark.createDataFrame([], "doc_id long, text string, source string")
    assert token_counts.token_counts(e, WORD).collect() == []
    assert licences.scan(e).collect() == []
    assert sharding.shard(e, [1.0, 1.0]).collect() == []
    assert packing.pack_documents(e, BYTE).collect() == []
    assert mixing.materialise(mixing.assign(e)).collect() == []
    folder = scratch_path(spark, "records-empty")
    assert records.read_records(spark, records.write_records(e, BYTE, folder), folder).collect() == []


def test_distinct_parts_are_encoded_together(spark):
    """The library gets many parts in one text, and ids are its own."""
    import random

    import pyarrow as pa
    import public_tokenizers
    from tessera.llm.common import ItemTokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(1 << 40):x}" + rng.choice(["", "", ".", ",", ".\nNext", "é.", "中,"])
                      for _ in range(40)) for _ in range(100)]
    texts += [None, "", "one", "a\n\nb c", "x\ny. z\n", "two  spaces", "'s 's.", ".\n. ,", "<|endoftext|> a", "é\u0301. \x85a"]

    class Counted:
        def __init__(self, tok):
            self.tok, self.texts = tok, 0

        def encode_batch_fast(self, texts, **more):
            self.texts += len(texts)
            return self.tok.encode_batch_fast(texts, **more)

    for size in (1000, 80 << 20):
        tok = ItemTokenizer(path, size)
        tok.tok = Counted(tok.tok)
        for _ in range(2):
            ids, off = tok.encode(pa.array(texts))
            for k, t in enumerate(texts):
                assert list(ids[off[k]:off[k + 1]]) == lib.encode(t or "", add_special_tokens=False).ids
        assert tok.tok.texts < 100                         # of some 4,000 distinct words
