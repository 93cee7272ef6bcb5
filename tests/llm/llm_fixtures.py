"""Fixtures of the operator tests; the session comes from ``tests/conftest.py``."""

import pytest

from tessera.session import ship_package

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """The texts of the small table, with awkward rows: null and empty texts,
    white space only, a very long text, a repeated row, null ids, added tokens."""
    rows = [(r.doc_id, r.text, r.source) for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()][:120]
    word = "lorem ipsum dolor sit amet "
    rows += [(-1, None, None), (-2, "", "s"), (-3, " \t\n", "s"), (-4, word * 20_000, "s"), (-4, word * 20_000, "s"),
             (None, "no id here at all, none", None), (None, None, "s"),
             (-7, "a<|endoftext|>b <|startoftext|> c", "s"), (-8, "  two  spaces \n and\n\nlines ", "s"),
             (-9, "İSTANBUL K é ΑΣ ſ Ǆ ﬁ  x y\x1cz ’s it's", "s"), (-10, "x" * 5000, "s"),
             (-11, "0.5 a.b,c. d,. e\nF g.\n H", "s"), (-12, "CC-BY cc by, All rights RESERVED! cc", "s"),
             (-13, "the MIT License; released under the MIT license", "s")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, documents):
    """As a frame, with extra columns whose names clash with results."""
    df = spark.createDataFrame(documents, "doc_id long, text string, source string").repartition(3)
    return df.selectExpr("*", "1 AS size", "2 AS n_tokens", "'x' AS score", "3 AS start", "4 AS shard", "5 AS `a b`")
