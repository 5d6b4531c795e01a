"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is timed to a full materialisation of its result (a no-op write),
so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordmill.plans.catalog import BENCH_QUERIES, QUERIES  # noqa: E402
from wordmill.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) * 2 if cpus != "*" else 16, app="wordmill-bench")
    names = only or BENCH_QUERIES
    # Warm the JVM (class loading, JIT, codegen) on the smallest tables, not the measured ones.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in ("vocab_build", "skipgram_pairs"):
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t0, 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
