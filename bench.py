"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall time in seconds.

Each query is materialised fully with a no-op write (``format("noop")``),
so every row is computed but nothing is collected to the driver.  A
warm-up pass over the sf0.001 tables precedes the timed runs; each
query's time is the median of ``$BENCH_REPEAT`` (default 3) runs; queries
that write, stream or repeat batches are run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.plans.upkeep import UPKEEP  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    # over-provisioned; AQE merges small post-shuffle partitions
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus * 8)))
    spark = get_session("tidemark-bench", master=f"local[{cpus}]", shuffle_partitions=shuffle,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    # the streams take their time to start, whatever the tables hold
    streams = {"topic_load", "stream_counters", "stream_change_table", "refresh_cycles"}
    names = only or [n for n in QUERIES if n not in streams]
    reading = {"payload_drift", "payload_typed", "cells_as_of", "exact_split", "preview_orders"}
    once = {n for n in QUERIES if n.startswith("sink_") or (n in UPKEEP and n not in reading)}
    # Warm-up on the smallest tables (JVM JIT and generated-code cache);
    # timed runs below then measure the query work at the target scale.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for n in names:
            QUERIES[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    times = {}
    for n in names:
        runs = []
        for _ in range(1 if n in once else repeat):
            t0 = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
