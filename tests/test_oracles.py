"""Every registered query against its DuckDB oracle (small scale factor);
rows-only queries must run and return rows."""

import pytest

from tessera.registry import ORACLES, QUERIES, load_all

from conftest import SF_SMALL

load_all()
import sys, os  # noqa: E401,E402
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import compare, duck  # noqa: E402

_CON = {}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    con = _CON.setdefault("c", duck(SF_SMALL))
    ok, msg = compare(spark, SF_SMALL, name, con)
    assert ok, msg
    if name not in ORACLES:
        assert "rows-only" in msg


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
