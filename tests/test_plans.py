"""Plan guards for every registered query: no Cartesian products or nested-loop
joins, and every parquet scan reads only the columns the query needs."""

import re

import pytest

from tessera.registry import QUERIES, load_all

from conftest import SF_SMALL

load_all()

# widest column set a query legitimately reads from each table
TABLE_COLUMNS = {"lineitem": 11, "orders": 6, "part": 6, "events": 6, "embeddings": 3}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pair_joins_and_pruned_scans(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    checked = 0
    for line in plan.split("\n"):
        m = re.search(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet", line)
        if not m:
            checked += "FileScan parquet" in line      # a table the query wrote itself
            continue
        cols, table = m.group(1).split(","), m.group(2)
        if table in TABLE_COLUMNS and table != "embeddings":
            assert len(cols) < TABLE_COLUMNS[table], f"{name} reads every column of {table}"
        checked += 1
    assert checked or "FileScan parquet" not in plan
