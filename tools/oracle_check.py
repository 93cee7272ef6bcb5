"""Run registered queries on Spark and their SQL oracles on DuckDB; compare.

    python tools/oracle_check.py [sf_dir] [name ...]

Compares column names, row counts and the multiset of rows (columns sorted by
name, values compared exactly after the 4-decimal rounding both sides apply).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.registry import ORACLES, QUERIES, load_all  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "date": "DATE"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir: str, name: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return True, f"rows-only ({len(s_rows)} rows)"
    res = con.execute(ORACLES[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    d_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    if s_types != d_types:
        return False, f"types differ: spark={s_types} duck={d_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"ok ({len(s_rows)} rows)"


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    if os.environ.get("PLAIN_SESSION"):
        # the driver's view: a session without this package's defaults
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from tessera.session import get_session
        spark = get_session(master="local[8]", shuffle_partitions=8)
    load_all()
    con = duck(sf_dir)
    fails = 0
    for name in names or sorted(QUERIES):
        t = time.time()
        try:
            ok, msg = compare(spark, sf_dir, name, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        fails += not ok
        print(f"{'PASS' if ok else 'FAIL'} {name:32s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{len(names or QUERIES) - fails} passed, {fails} failed")
    sys.exit(1 if fails else 0)


if __name__ == "__main__":
    main()
