"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and fully executed into Spark's ``noop`` sink (nothing is
collected to the driver). One warm-up run, then $BENCH_RUNS timed runs; the
per-query value is the median. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.registry import QUERIES, load_all  # noqa: E402
from tessera.session import get_session  # noqa: E402


def run_once(spark, fn, sf_dir: str) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session("tessera-bench", master=f"local[{cpus}]", shuffle_partitions=2 * cpus,
                        extra={"spark.driver.memory": "16g",
                               "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    load_all()
    names = only or sorted(QUERIES)
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            run_once(spark, QUERIES[name], sf_dir)            # warm-up
            times[name] = round(statistics.median(run_once(spark, QUERIES[name], sf_dir)
                                                  for _ in range(runs)), 4)
        except Exception as e:  # keep measuring the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"{name}: {times.get(name, 'ERROR')}", file=sys.stderr, flush=True)
    out = {"metric": "total_median_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus,
           "runs": runs, "spark": spark.version}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
