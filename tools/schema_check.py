"""Compare column types of every query (Spark) with its oracle (DuckDB).

    python tools/schema_check.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import duck  # noqa: E402
from tessera.registry import ORACLES, QUERIES, load_all  # noqa: E402
from tessera.session import get_session  # noqa: E402

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "date": "DATE"}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("tessera-schema", master="local[8]", shuffle_partitions=8)
    load_all()
    con = duck(sf)
    bad = 0
    for name in sorted(ORACLES):
        s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in QUERIES[name](spark, sf).schema.fields}
        d_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
        if s_types != d_types:
            bad += 1
            diff = {k: (s_types.get(k), d_types.get(k)) for k in set(s_types) | set(d_types)
                    if s_types.get(k) != d_types.get(k)}
            print(f"MISMATCH {name}: {diff}", flush=True)
    print(f"{len(ORACLES) - bad} schemas equal, {bad} differ")


if __name__ == "__main__":
    main()
