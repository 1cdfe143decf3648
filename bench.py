"""Bench: wall time of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Warm session, each query executed 3 times through the ``noop`` sink (full
execution, nothing collected), median reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "search", "fact_chunk", "chunk_compatibility", "perf_marts", "scored_mart", "anchor_alignment",
    "assemble_pairs", "assemble_sequences", "semantic_topk", "semantic_join", "bm25_search",
    "lineage_contract", "near_dup_flag", "dq_perf_release", "embed_incremental", "ttl_plan",
    "stream_daily_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = sys.argv[1:] or HEADLINE

    from clipmart.plans.catalog import QUERIES
    from clipmart.session import local_session

    mem = os.environ.get("BENCH_MEM", "6g")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), driver_memory=mem)
    QUERIES["search"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up

    times: dict[str, float] = {}
    for k in keys:
        samples = []
        for _ in range(runs):
            t = time.perf_counter()
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t)
        times[k] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_median_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
