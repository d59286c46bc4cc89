"""Times the headline queries; prints one JSON line. BENCH_SF_DIR, BENCH_CPUS (8), BENCH_RUNS (3: the median counts)."""

from __future__ import annotations

import json
import os
import time
from statistics import median

from lakeferry.queries import QUERIES
from lakeferry.session import build

#: The reference figures' own steps; the rest of the suite is left to the correctness check.
HEADLINE = ["q1_pricing_summary", "q6_revenue", "scan_full", "scan_two_columns", "topn", "topn_filtered", "join_inner", "agg_distinct", "aggregate_then_write", "copy_create", "copy_parallel_exactly_once", "update_pk", "delete_composite_pk", "ctas", "except_all"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = build(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = {k: QUERIES[k] for k in HEADLINE}, {}
    try:
        from lakeferry.llm.queries import QUERIES as more

        queries |= more
    except ModuleNotFoundError as e:  # the subpackage isn't there
        if e.name not in ("lakeferry.llm", "lakeferry.llm.queries"):
            raise
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    for name, f in queries.items():
        times = []
        for _ in range(1 + (runs if not name.startswith("op") else 1)):  # the first run loads code
            t = time.perf_counter()
            f(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        took[name] = round(median(times[1:]), 3)
    print(json.dumps({"metric": "total of headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
