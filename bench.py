"""Benchmark the headline queries.

Runs each query of HEADLINE at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS], forcing full evaluation with the no-op sink, and
prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "markers_top10_flagged",     # flagship: filter -> lognorm -> Wilcoxon -> BH -> top 10
    "qc_cells",                  # A1
    "hvg_seurat",                # N3
    "classify_cells",            # L1
    "abnormal_clusters_ratio",   # R1
    "rank_genes_vs_reference",   # D2
    "enrich",                    # E1
    "knn",                       # G3
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cellspark.session import spark_session
    spark = spark_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    from cellspark.plans.registry import QUERIES
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
