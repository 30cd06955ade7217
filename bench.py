"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session (default 8)
BENCH_RUNS     runs per query; the fastest counts (default 2)
BENCH_QUERIES  names separated by commas (default: HEADLINE; ``all`` for every query)
"""

from __future__ import annotations

import json
import os
import sys
import time

from gevel.catalog import all_queries
from gevel.session import local_session

HEADLINE = [
    "overlap", "label", "neighbours", "adjacent", "region_of_point", "points_in_box", "quadtree", "tile_cells",
    "reconstruction_input", "external_features", "snapshot", "dedupe", "units", "lod_layers", "layer_counts",
    "obj_lines", "reports", "presence", "attributes", "log_times", "surfaces", "checksums",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    queries = all_queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = list(queries) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "gevel-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name} {best:.2f}", file=sys.stderr)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
