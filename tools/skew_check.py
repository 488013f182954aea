"""Skew check: run the key-sensitive operators on a lineitem table where
one part key holds a third of all rows, and report, per shuffle-reading
stage, the largest and the median number of shuffled records read by a
task (from Spark's event log in a scratch folder).

usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import statistics
import sys
import tempfile

import zstandard

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import analytics, kv, state  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    spark = get_session("tidemark-skew", master="local[8]", shuffle_partitions=32,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                               "spark.eventLog.compression.codec": "zstd"})
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    # a third of all rows move to part key 1
    skewed = li.withColumn("l_partkey", F.when(F.pmod("l_orderkey", F.lit(3)) == 0, F.lit(1))
                                          .otherwise(F.col("l_partkey")))
    runs = {
        "latest_per_key": lambda: state.latest_per_key(
            skewed.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"),
            "l_partkey", ["l_shipdate", "l_orderkey", "l_linenumber"]),
        "keep_versions": lambda: kv.keep_versions(
            skewed.select("l_partkey", "l_shipdate", "l_orderkey"), "l_partkey", "l_shipdate",
            3, "l_orderkey"),
        "new_product_trend": lambda: analytics.new_product_trend(skewed),
        "basket_affinity": lambda: analytics.basket_affinity(skewed),
    }
    for name, mk in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        mk().write.format("noop").mode("overwrite").save()
    spark.stop()

    f = glob.glob(f"{logdir}/*/events_*")[0]
    text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
    stage_job, job_group, reads = {}, {}, {}
    for line in text:
        try:
            e = json.loads(line)
        except ValueError:
            continue
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_job[s] = g
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            r = (m.get("Shuffle Read Metrics") or {})
            n = r.get("Total Records Read", 0)
            if n:
                reads.setdefault(e["Stage ID"], []).append(n)
    print(f"{'operator':20s} {'stage':>5s} {'tasks':>5s} {'max rows':>9s} {'median':>8s} {'total':>9s}")
    for s in sorted(reads):
        v = reads[s]
        print(f"{str(stage_job.get(s)):20s} {s:5d} {len(v):5d} {max(v):9d} {int(statistics.median(v)):8d} {sum(v):9d}")


if __name__ == "__main__":
    main()
