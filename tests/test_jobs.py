"""End-to-end batch jobs on the fixture inputs."""

import json
import os

from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.plans import jobs
from tidemark.sinks import writers


def test_address_corpus_jobs(spark, tmp_dir):
    src = os.path.join(tmp_dir, "sample_address_data.json")
    with open(src, "w") as f:
        json.dump([{"address": r[0]} for r in fixed.ADDRESS_ROWS], f, ensure_ascii=False)
    out = os.path.join(tmp_dir, "regex_corpus")
    jobs.address_corpus_job(spark, src, out, "regex")
    c = spark.read.json(out)
    assert c.count() == 28 and set(c.columns) == {"instruction", "input", "output", "original_address"}
    assert c.where(F.col("input") != "").count() == 0
    rule = jobs.address_corpus(
        spark.createDataFrame(fixed.ADDRESS_ROWS, "address string, province string, city string, "
                                                  "district string, street string"), "rule")
    assert rule.count() == 40

    enc_out = os.path.join(tmp_dir, "encoded")
    jobs.encode_corpus_job(spark, out, enc_out)
    e = spark.read.parquet(enc_out)
    assert e.count() == 28 and e.where("size(input_ids) = 128").count() == 28
    assert {r.split for r in e.select("split").distinct().collect()} <= {"train", "eval"}


def test_rate_refresh_job(spark, tmp_dir):
    base, snap, changes = (os.path.join(tmp_dir, x) for x in ("state", "snap", "changes"))
    os.makedirs(snap)
    with open(os.path.join(snap, "s.json"), "w") as f:
        f.write(json.dumps({"base_currency": "GBP", "target_currency": "JPY", "rate": 150.5}) + "\n")
    now = F.lit("2025-10-03 10:00:00").cast("timestamp_ntz")
    assert jobs.rate_refresh_job(spark, base, snap, changes, 3600, as_of=now) == 0
    st = {(r.base_currency, r.target_currency): r for r in writers.read_state(spark, base).collect()}
    assert len(st) == 18 and st[("GBP", "JPY")].rates == {"JPY": 150.5}
    assert st[("GBP", "USD")].rates == {"USD": 1.37} and st[("GBP", "USD")].is_fallback
    later = F.lit("2025-10-03 11:00:00").cast("timestamp_ntz")
    assert jobs.rate_refresh_job(spark, base, snap, changes, 3600, as_of=later) == 1
    assert spark.read.json(changes).count() == 36   # everything due again after exactly one interval


def test_sync_tables(spark, tmp_dir):
    url = "jdbc:derby:memory:syncdb;create=true"
    opts = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.range(1, 501).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("status")) \
        .write.format("jdbc").option("url", url).option("dbtable", "sync_orders").options(**opts).mode("overwrite").save()
    spark.range(1, 26).select(F.col("id").alias("nation_id")) \
        .write.format("jdbc").option("url", url).option("dbtable", "sync_nation").options(**opts).mode("overwrite").save()
    out = jobs.sync_tables(spark, url, {
        "sync_orders": {"key": "order_id", "partition_column": "order_id", "lower_bound": 1,
                        "upper_bound": 500, "num_partitions": 4},
        "sync_nation": {"key": "nation_id"},
    }, os.path.join(tmp_dir, "copy"), opts)
    r = {x.table_name: x for x in out.collect()}
    assert r["sync_orders"].source_rows == 500 and r["sync_orders"].copy_rows == 500
    assert r["sync_orders"].source_key_sum == str(500 * 501 // 2)
    assert all(x.in_sync for x in r.values())
