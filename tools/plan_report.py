"""Summarise the physical plan of every registered query into PLANS.md.

    python tools/plan_report.py [sf_dir]

For each query: scans with their pruned ReadSchema / PushedFilters, the
exchanges (hash / range / single-partition), broadcast joins, windows and
Python (Arrow) operators of the plan Spark would run. Fits and other eager
steps a query performs while it is built are not part of its final plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.registry import QUERIES, load_all  # noqa: E402
from tessera.session import get_session  # noqa: E402

HEADER = """# Physical plans of the registered queries

Generated by `tools/plan_report.py` from `executedPlan` (before adaptive
re-planning) at {sf}. `single` exchanges are the final step of a global
aggregate (one partial row per task) or windows over bounded derived tables
(md5-bucket offsets, split offsets, per-epoch histories, dictionaries under
the checked size) - never a sort or gather of a data-sized input.

| query | scans (columns read, pushed filters) | hash | range | single | broadcast | window | python |
| --- | --- | --- | --- | --- | --- | --- | --- |
"""


def summarise(plan: str) -> dict:
    scans = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        line = m.group(0)
        rs = re.search(r"ReadSchema: struct<([^>]*)>", line)
        pf = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        cols = [c.split(":")[0] for c in rs.group(1).split(",")] if rs else []
        scans.append(f"{len(cols)} cols" + (f", filters [{pf.group(1)}]" if pf and pf.group(1) else ""))
    return {
        "scans": "; ".join(scans) or "-",
        "hash": plan.count("Exchange hashpartitioning"),
        "range": plan.count("Exchange rangepartitioning"),
        "single": plan.count("Exchange SinglePartition"),
        "broadcast": plan.count("BroadcastExchange"),
        "window": len(re.findall(r"\bWindow \[", plan)),
        "python": plan.count("MapInArrow") + plan.count("ArrowEvalPython") + plan.count("BatchEvalPython"),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("tessera-plans", master="local[8]", shuffle_partitions=8)
    load_all()
    lines = [HEADER.format(sf=os.path.basename(sf))]
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        lines.append(f"| {name} | {s['scans']} | {s['hash']} | {s['range']} | {s['single']} | "
                     f"{s['broadcast']} | {s['window']} | {s['python']} |\n")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.writelines(lines)
    print(f"wrote {out}")
    spark.stop()


if __name__ == "__main__":
    main()
