"""Time the headline queries at one scale factor; print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    BENCH_QUERIES=all python bench.py        # every registered query

Each query is planned from scratch and executed end to end with a ``noop``
write (every row produced, nothing collected).  Every query runs once unmeasured,
then its time is the best of ``BENCH_REPEAT`` runs (default 2), so the order of the
queries does not matter.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rfm_features", "inactivity_label", "model_dataset", "ordered_split", "encoded_dataset",
    "correlation_matrix", "risk_correlation", "dedup_stats", "date_coverage", "referential_integrity",
    "segment_summary", "describe_by_segment", "boxplot_stats", "recency_histogram",
    "monthly_volume_econ", "ledger_profile", "missing_audit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "")

    from lapse.plans.catalog import queries
    from lapse.session import local_session

    spark = local_session(cpus, shuffle_partitions=cpus)
    qs = queries()
    # BENCH_QUERIES: unset = headline set, "all" = every registered query, or a comma list
    names = list(qs) if wanted == "all" else (wanted.split(",") if wanted else HEADLINE)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times = {}
    for name in names:
        run(name)  # warm-up: JVM, codegen caches, file listing
        times[name] = round(min(run(name) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total" if names == HEADLINE else "queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
