"""Benchmark: wall time of the headline queries.

Runs each query once to warm up, then ``BENCH_RUNS`` times (default 3), and
reports the median.  Every run executes the full plan into Spark's ``noop``
sink (nothing is collected to the driver).  Prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (default 3), BENCH_QUERIES (comma list, default headline set,
     "all" for every registered query).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "quarterly_table",
    "consolidate_baseline",
    "flag_by_arm",
    "category_crosstab",
    "fill_within_group",
    "assemble_participant",
    "score_scale",
    "scale_by_wave",
    "effect_size",
    "employment_status",
    "compensation",
    "full_join_waves",
    "multi_select_any",
    "primary_record",
    "flatten_records",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    sel = os.environ.get("BENCH_QUERIES", "")

    from panelkit.queries import QUERIES
    from panelkit.session import local_session

    names = list(QUERIES) if sel == "all" else (sel.split(",") if sel else HEADLINE)
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app_name="panelkit-bench")

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        fn = QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            once()  # warm-up: JIT, file listing, broadcast of dimensions
            times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        except Exception as e:  # noqa: BLE001 - report, keep benchmarking the rest
            failed[name] = str(e).splitlines()[0][:200]

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "runs": runs,
        "spark": spark.version,
        **({"failed": failed} if failed else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
