"""Quoted line breaks read over many splits against one-task reads."""

import csv
import io
import random

import pytest

from tessera.sources.csv import read_csv
from tessera.sources.records import line_scanner


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["a", "b,", "\n", '"', "x y", "\r\n", "", "line", "\n\n", "7"]
    return [[str(k), "".join(rng.choice(parts) for _ in range(rng.randrange(0, 9))) + "z",
             "q" * rng.randrange(0, 30) + "z"] for k in range(n)]


def body(rows):
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("size", [150, 1 << 20])
def test_many_splits_equal_one_task(spark, tmp_path, size):
    rows = texts(size, 150)
    rows[60][1] = "long\n" * 60 + "z"                      # a field over several splits
    (tmp_path / "part-2.csv").write_text(body([["id", "text", "more"]] + rows[:90]), newline="")
    (tmp_path / "part-10.csv").write_text(body([["id", "text", "more"]] + rows[90:]) + "\n\n", newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        t = read_csv(spark, str(tmp_path), multi_line=True, escape='"')
        got = [(r.row_id, r.id, r.text, r.more) for r in t.df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert t.header and t.numeric == ["id"]
    assert sorted(got) == [(k, float(r[0]), r[1], r[2]) for k, r in enumerate(rows)]
    one = spark.read.csv(str(tmp_path), header=True, multiLine=True, escape='"')
    assert sorted((g[1], g[2], g[3]) for g in got) == sorted((float(r.id), r.text, r.more) for r in one.collect())


def test_scanner_states():
    after = line_scanner(",", '"')
    for line, outside, inside in [("a,b", False, True), ('"a', True, False), ('a"b', False, False), ('"a""', True, True),
                                  ('a,"b', True, True), ('",x', True, False), ('"a"x"y,"', True, True)]:
        assert after(line, False) is outside, line
    assert after('a"', True) is False and after('a""', True) is True and after('a","b', True) is True
    back = line_scanner(",", "\\")
    assert back('"a\\"', False) is True and back('"a\\\\"', False) is False
