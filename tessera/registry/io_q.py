"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.missing import MISSING_TOKENS, normalise_string, parse_double
from tessera.functions.numeric import r4
from tessera.operators.scale import fit_scaler
from tessera.registry.base import R, query, tbl
from tessera.session import scratch_path
from tessera.sources.csv import make_csv, read_csv
from tessera.sources.preview import preview
from tessera.sources.scaler_io import load_scaler, save_scaler

ORDER_COLS = ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]


@query("csv_roundtrip", f"""
SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_id,
       CAST(o_orderkey AS DOUBLE) AS o_orderkey, {R('round(o_totalprice, 6)')} AS o_totalprice,
       o_orderstatus, o_orderpriority
FROM orders
""")
def q_csv_roundtrip(spark, sf):
    src = tbl(spark, sf, "orders", ORDER_COLS)
    path = scratch_path(spark, "csv_roundtrip")
    make_csv(src, path, numeric=["o_orderkey", "o_totalprice"],
             strings=["o_orderstatus", "o_orderpriority"], order_by="o_orderkey")
    t = read_csv(spark, path)
    if t.numeric != ["o_orderkey", "o_totalprice"] or not t.header:
        raise AssertionError(f"inferred {t.numeric} header={t.header}")
    return t.df.select("row_id", "o_orderkey", r4("o_totalprice").alias("o_totalprice"),
                       "o_orderstatus", "o_orderpriority")


@query("csv_quoted_breaks", f"""
SELECT CAST(doc_id AS DOUBLE) AS doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n_chars
FROM (SELECT doc_id, CASE WHEN text IN ({", ".join(f"'{t}'" for t in [*MISSING_TOKENS, ""])}) THEN NULL ELSE text END AS text
      FROM documents)
""")
def q_csv_quoted_breaks(spark, sf):
    """Whole texts, line breaks and quotes included, through delimited text."""
    docs = tbl(spark, sf, "documents", ["doc_id", "text"])
    path = scratch_path(spark, "csv_quoted_breaks")
    (docs.write.option("header", True).option("quoteAll", True).option("escape", '"').option("lineSep", "\n")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    t = read_csv(spark, path, multi_line=True, escape='"')
    return t.df.select("doc_id", F.md5("text").alias("text_md5"), F.char_length("text").cast("long").alias("n_chars"))


_TOKENS = list(MISSING_TOKENS) + [""]
_TOKEN_SQL = "[" + ", ".join(f"'{t}'" for t in _TOKENS) + "]"
_TOKEN_IN = ", ".join(f"'{t}'" for t in _TOKENS)


@query("missing_normalise", f"""
WITH raw AS (
  SELECT event_id,
         CASE WHEN event_id % 7 = 0 THEN {_TOKEN_SQL}[((event_id // 7) % {len(_TOKENS)}) + 1]
              ELSE CAST(value AS VARCHAR) END AS value_s,
         CASE WHEN event_id % 11 = 0 THEN {_TOKEN_SQL}[((event_id // 11) % {len(_TOKENS)}) + 1]
              ELSE event_type END AS type_s
  FROM events)
SELECT event_id,
       CASE WHEN type_s IN ({_TOKEN_IN}) THEN NULL ELSE type_s END AS event_type,
       {R(f"CASE WHEN value_s IN ({_TOKEN_IN}) THEN NULL ELSE TRY_CAST(value_s AS DOUBLE) END")} AS value
FROM raw
""")
def q_missing_normalise(spark, sf):
    e = tbl(spark, sf, "events", ["event_id", "event_type", "value"])
    toks = F.array(*[F.lit(t) for t in _TOKENS])
    n = len(_TOKENS)
    raw = e.select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.element_at(toks, F.expr(f"CAST((event_id div 7) % {n} + 1 AS INT)")))
         .otherwise(F.col("value").cast("string")).alias("value_s"),
        F.when(F.col("event_id") % 11 == 0, F.element_at(toks, F.expr(f"CAST((event_id div 11) % {n} + 1 AS INT)")))
         .otherwise(F.col("event_type")).alias("type_s"))
    out = raw.select("event_id", normalise_string(F.col("type_s")).alias("event_type"),
                     parse_double(F.col("value_s")).alias("value"))
    return out.select("event_id", "event_type", r4("value").alias("value"))


@query("preview_rows", """
SELECT o_orderkey, printf('%.2f', CAST(o_custkey AS DOUBLE)) AS o_custkey,
       printf('%.2f', o_totalprice) AS o_totalprice, o_orderstatus,
       CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS row_no
FROM orders ORDER BY o_orderkey LIMIT 10
""")
def q_preview_rows(spark, sf):
    src = tbl(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    return preview(src, 10, key="o_orderkey")


@query("preview_last_rows", """
SELECT o_orderkey, printf('%.2f', CAST(o_custkey AS DOUBLE)) AS o_custkey,
       printf('%.2f', o_totalprice) AS o_totalprice, o_orderstatus,
       CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS row_no
FROM orders QUALIFY row_no > (SELECT count(*) FROM orders) - 10
""")
def q_preview_last_rows(spark, sf):
    src = tbl(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    return preview(src, 10, key="o_orderkey", end="last")


@query("preview_all_rows", """
SELECT o_orderkey, printf('%.2f', CAST(o_custkey AS DOUBLE)) AS o_custkey,
       printf('%.2f', o_totalprice) AS o_totalprice, o_orderstatus,
       CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS row_no
FROM orders
""")
def q_preview_all_rows(spark, sf):
    src = tbl(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    return preview(src, -1, key="o_orderkey")


LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("scaler_roundtrip", "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS BIGINT) AS idx, '{c}' AS feature, {R(f'avg({c})')} AS a, "
    f"{R(f'stddev_samp({c})')} AS b FROM lineitem" for i, c in enumerate(LINE_NUM)))
def q_scaler_roundtrip(spark, sf):
    sc = fit_scaler(tbl(spark, sf, "lineitem", LINE_NUM), LINE_NUM, "standard")
    path = scratch_path(spark, "scaler")
    save_scaler(spark, sc, path)
    back = load_scaler(spark, path, "standard")
    return back.to_frame(spark).select(F.col("idx").cast("long").alias("idx"), "feature",
                                       r4("a").alias("a"), r4("b").alias("b"))
