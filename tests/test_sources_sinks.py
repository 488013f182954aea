"""Sources, catalog DDL and sinks."""

import json
import os

from pyspark.sql import functions as F

from tidemark.operators import refresh
from tidemark.sinks import writers
from tidemark.sources import catalog, files, jdbc


def test_delimited_partitioned_table(spark, tmp_dir):
    part = os.path.join(tmp_dir, "user_actions", "ds=20250925")
    os.makedirs(part)
    with open(os.path.join(part, "a.csv"), "w") as f:
        f.write("user_id,user_name,action_type,product_id,amount,action_time\n")
        for i in range(8):
            f.write(f"{i},u{i},view,p{i},{i * 1.5},2025-09-25 10:0{i}:00\n")
    catalog.create_database(spark, "behavior_analysis")
    catalog.drop_table(spark, "behavior_analysis.user_actions")
    catalog.create_delimited_table(
        spark, "behavior_analysis.user_actions",
        "user_id INT, user_name STRING, action_type STRING, product_id STRING, amount DOUBLE, "
        "action_time STRING, ds STRING", os.path.join(tmp_dir, "user_actions"), "ds")
    catalog.add_partition(spark, "behavior_analysis.user_actions", {"ds": "20250925"})
    catalog.add_partition(spark, "behavior_analysis.user_actions", {"ds": "20250925"})  # re-run is fine
    df = spark.sql("SELECT * FROM behavior_analysis.user_actions WHERE ds = '20250925' ORDER BY user_id LIMIT 5")
    rows = df.collect()
    assert len(rows) == 5 and rows[0].user_id == 0 and rows[1].amount == 1.5
    plan = df._jdf.queryExecution().executedPlan().toString()
    pf = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
    assert "ds" in pf and "20250925" in pf      # the day filter prunes partitions
    assert any(r.namespace == "behavior_analysis" for r in catalog.show_databases(spark).collect())
    assert catalog.engine_version(spark).first().version
    spark.sql("USE default")


def test_load_records_and_state(spark, tmp_dir):
    p = os.path.join(tmp_dir, "sample.json")
    with open(p, "w") as f:
        json.dump([{"address": "北京市海淀区中关村大街1号"}, {"address": "x"}], f, ensure_ascii=False)
    assert files.load_records(spark, p).count() == 2
    c = os.path.join(tmp_dir, "s.csv")
    with open(c, "w") as f:
        f.write("address\nA\nB\n")
    assert files.load_records(spark, c).count() == 2
    try:
        files.load_records(spark, os.path.join(tmp_dir, "none.txt"))
        raise AssertionError("expected failure")
    except ValueError:
        pass
    sample = files.load_records(spark, os.path.join(tmp_dir, "none.txt"), sample_if_unknown=True)
    assert [r.address for r in sample.collect()][0] == "北京市海淀区中关村大街1号" and sample.count() == 3
    s = os.path.join(tmp_dir, "state.json")
    with open(s, "w") as f:
        json.dump([{"province": "北京", "update_time": "2025-10-03 21:00:00"},
                   {"province": "上海", "update_time": "garbage", "is_fallback": True}], f, ensure_ascii=False)
    st = files.load_state(spark, s)
    got = {r.province: r.last_update for r in st.collect()}
    assert got["北京"] is not None and got["上海"] is None
    assert files.last_update_per_key(st, "province").count() == 2


def test_jdbc_in_process(spark):
    url = "jdbc:derby:memory:tmdb;create=true"
    opts = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    ch = spark.range(1, 101).select(F.col("id").alias("change_id"),
                                    F.lit("users").alias("table_name"),
                                    (F.col("id") % 7).cast("int").alias("record_id"))
    ch.write.format("jdbc").option("url", url).option("dbtable", "users_changelog").options(**opts).mode("overwrite").save()
    got = jdbc.changes_after(spark, url, "users_changelog", 90, options=opts)
    assert [r.change_id for r in got.collect()] == list(range(91, 101))
    split = jdbc.changes_after(spark, url, "users_changelog", 10, options=opts, upper=100, num_partitions=3)
    assert split.count() == 90
    parted = jdbc.read_table(spark, url, "users_changelog", opts, "change_id", 1, 100, 4)
    assert parted.rdd.getNumPartitions() == 4 and parted.count() == 100
    # catalog listing with the equality filter pushed to the database
    tabs = jdbc.catalog_tables(spark, url, "T", opts, catalog_view="SYS.SYSTABLES", schema_col="TABLETYPE")
    assert "USERS_CHANGELOG" in {r.TABLENAME for r in tabs.collect()}


def test_versioned_state(spark, tmp_dir):
    base = os.path.join(tmp_dir, "state")
    b1 = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, seq int")
    b2 = spark.createDataFrame([(2, "b2", 2), (3, "c", 2)], "k int, v string, seq int")
    assert writers.upsert_state(spark, b1, base, ["k"], ["seq"]) == 0
    assert writers.upsert_state(spark, b2, base, ["k"], ["seq"]) == 1
    v2 = {tuple(r) for r in writers.read_state(spark, base).select("k", "v", "seq").collect()}
    writers.upsert_state(spark, b2, base, ["k"], ["seq"])   # replayed batch
    v3 = {tuple(r) for r in writers.read_state(spark, base).select("k", "v", "seq").collect()}
    assert v2 == v3 == {(1, "a", 1), (2, "b2", 2), (3, "c", 2)}


def test_day_bucketed_table_and_expiry(spark):
    df = spark.createDataFrame(
        [(i, f"2025-10-{d:02d} 10:00:00", f"n{i}") for i, d in enumerate([1, 2, 2, 9, 10, 20])],
        "id long, cdc_time string, name string").withColumn("cdc_time", F.to_timestamp("cdc_time"))
    df = df.withColumn("ds", F.date_format("cdc_time", "yyyy-MM-dd"))
    spark.sql("DROP TABLE IF EXISTS users_loaded")
    writers.write_day_bucketed(df, "users_loaded", "ds", "id", ("id", "cdc_time"), 8)
    assert spark.table("users_loaded").count() == 6
    dropped = writers.expire_day_partitions(spark, "users_loaded", "2025-10-10")
    assert sorted(dropped) == ["2025-10-01", "2025-10-02", "2025-10-20"]
    assert spark.table("users_loaded").count() == 2
    try:
        writers.write_day_bucketed(df.select("name", "id", "cdc_time", "ds"), "users_bad", "ds", "id")
        raise AssertionError("expected key-prefix error")
    except ValueError:
        pass


def test_corpus_and_log_files(spark, tmp_dir):
    pairs = spark.createDataFrame([("q", "a", "addr")], "instruction string, output string, original_address string")
    out = os.path.join(tmp_dir, "corpus")
    writers.write_corpus(pairs, out)
    r = spark.read.json(out).first()
    assert r.input == "" and r.instruction == "q"
    log = os.path.join(tmp_dir, "log")
    writers.append_jsonl(pairs, log)
    writers.append_jsonl(pairs, log)
    assert refresh.non_blank_lines(spark, log).first().lines == 2
    assert writers.preview(pairs, 1).count() == 1


def test_topic_records_and_create_if_absent(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, name string, x double")
    r = writers.as_topic_records(df, "id").first()
    assert r.key == "1" and json.loads(r.value) == {"id": 1, "name": "a"}
    spark.sql("DROP TABLE IF EXISTS users_empty")
    assert catalog.create_table_if_absent(spark, "users_empty", df) is True
    assert catalog.create_table_if_absent(spark, "users_empty", df) is False
    assert spark.table("users_empty").count() == 0
    catalog.check_key_prefix(["id", "cdc_time", "name"], ["id", "cdc_time"])


def test_bucketed_table_latest_without_shuffle(spark):
    from tidemark.operators import state
    df = spark.range(0, 2000).select((F.col("id") % 97).alias("id"),
                                     F.to_timestamp(F.lit("2025-10-01 00:00:00")).alias("cdc_time"),
                                     F.col("id").alias("seq"),
                                     F.lit("2025-10-01").alias("ds"))
    spark.sql("DROP TABLE IF EXISTS users_bucketed")
    writers.write_day_bucketed(df, "users_bucketed", "ds", "id", ("id", "cdc_time"), 8)
    latest = state.latest_per_key(spark.table("users_bucketed"), "id", ["cdc_time", "seq"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan            # bucketing on id co-locates every key
    got = {r.id: r.seq for r in latest.collect()}
    assert len(got) == 97 and got[0] == 1940


def test_views_and_checkpoint_paths(spark):
    from tidemark.session import checkpoint_dir, stream_checkpoint
    from tidemark.sources.tables import TABLES, register_views
    register_views(spark, "/root/testdata/sf0.001", ["region", "nation"])
    assert spark.sql("SELECT count(*) AS n FROM nation").first().n == 25
    assert len(TABLES) == 14
    base = checkpoint_dir(spark)
    assert stream_checkpoint(spark, "cdc").startswith(base) and base == spark.conf.get("spark.checkpoint.dir")


def test_scaled_conf():
    from tidemark.session import scaled_conf
    big = scaled_conf(100 * 2 ** 40, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2 ** 40 // (256 << 20))
    small = scaled_conf(10 << 20, 64)
    assert small["spark.sql.shuffle.partitions"] == str(3 * 64)
    assert small["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_partitioned_state_rewrites_touched_buckets(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pstate")
    b1 = spark.createDataFrame([(k, f"v{k}", 1) for k in range(100)], "k int, v string, seq int")
    writers.upsert_partitioned_state(spark, b1, path, ["k"], ["seq"], buckets=16)

    def files():
        out = {}
        for d in os.listdir(path):
            if d.startswith("_bucket="):
                out[d] = sorted(f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet"))
        return out

    before = files()
    b2 = spark.createDataFrame([(5, "new5", 2), (150, "v150", 2), (7, "old7", 0)], "k int, v string, seq int")
    writers.upsert_partitioned_state(spark, b2, path, ["k"], ["seq"], buckets=16)
    after = files()
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    want = {k: f"v{k}" for k in range(100)}
    want.update({5: "new5", 150: "v150"})
    assert got == want
    touched = {f"_bucket={r._bucket}" for r in
               b2.select(F.pmod(F.xxhash64("k"), F.lit(16)).cast("int").alias("_bucket")).collect()}
    untouched = [d for d in before if d not in touched]
    assert untouched and all(before[d] == after[d] for d in untouched)   # untouched buckets not rewritten
    assert all(before.get(d) != after[d] for d in touched if d in before)


def test_json_forms(spark, tmp_dir):
    lines, array, folder = (os.path.join(tmp_dir, x) for x in ("l.json", "a.json", "f.json"))
    with open(lines, "w") as f:
        f.write('{"address": "a"}\n{"address": "b"}\n{"address": "c"}\n')
    with open(array, "w") as f:
        json.dump([{"address": "a"}, {"address": "b"}], f, indent=1)
    pairs = spark.createDataFrame([(str(i), "o", "x") for i in range(10)], "instruction string, output string, original_address string")
    writers.write_corpus(pairs.repartition(3), folder)
    assert [files.load_records(spark, p).count() for p in (lines, array, folder)] == [3, 2, 10]
    assert files.load_state(spark, lines).count() == 3
    assert files.load_records(spark, array, multi_line=True).count() == 2


def test_state_sinks_replay(spark, tmp_dir):
    """Every keyed sink: a first batch is reduced, a repeated one changes nothing."""
    first = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k int, v string, seq int")
    base = os.path.join(tmp_dir, "state")
    for _ in range(2):
        writers.upsert_state(spark, first, base, "k", "seq")
        assert [r.v for r in writers.read_state(spark, base).collect()] == ["new"]
    assert writers.drop_old_versions(spark, base, keep=1) == [0]
    assert writers.read_state(spark, base).count() == 1

    cells = spark.createDataFrame([("r", t, f"v{t}") for t in (1, 2, 3)], "rowkey string, ts int, v string")
    base = os.path.join(tmp_dir, "cells")
    for _ in range(2):
        writers.keep_cell_versions(spark, cells, base, "rowkey", "ts")
        assert sorted(r.ts for r in spark.read.parquet(base).collect()) == [1, 2, 3]

    path = os.path.join(tmp_dir, "buckets")
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("seq"))
    writers.upsert_partitioned_state(spark, rows, path, "k", "seq", buckets=8)
    try:
        writers.upsert_partitioned_state(spark, rows, path, "k", "seq", buckets=4)
        raise AssertionError("expected another number of buckets to be refused")
    except ValueError:
        pass
    writers.upsert_partitioned_state(spark, rows, path, "k", "seq", buckets=8)
    assert spark.read.parquet(path).count() == 20 and "_staging" not in os.listdir(path)

    kv = os.path.join(tmp_dir, "kv")
    day = spark.createDataFrame([("20251001_a", "1", "20251001"), ("20251001_b", "1", "20251001")],
                                "rowkey string, v string, partition_date string")
    writers.write_kv_partitioned(spark, day, kv)
    change = day.where("rowkey = '20251001_b'").withColumn("v", F.lit("2"))
    for _ in range(2):
        writers.write_kv_partitioned(spark, change, kv)
        assert {r.rowkey: r.v for r in spark.read.parquet(kv).collect()} == {"20251001_a": "1", "20251001_b": "2"}


def test_commit_with_survives_a_failure(spark, tmp_dir, monkeypatch):
    base, log = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "log")
    df = spark.range(3)
    real = writers.commit_state
    monkeypatch.setattr(writers, "commit_state", lambda *a: 1 / 0)
    try:
        writers.commit_with(spark, df, base, {log: df})
    except ZeroDivisionError:
        pass
    monkeypatch.setattr(writers, "commit_state", real)
    assert writers.read_state(spark, base) is None
    assert writers.commit_with(spark, df, base, {log: df}) == 0
    assert spark.read.json(log).count() == 3


def test_day_buckets_have_one_file_each(spark):
    df = spark.range(2000).repartition(16).select(
        "id", F.lit("2025-10-01 00:00:00").cast("timestamp").alias("cdc_time"),
        F.concat(F.lit("2025-10-0"), F.col("id") % 3 + 1).alias("ds"))
    spark.sql("DROP TABLE IF EXISTS few_files")
    writers.write_day_bucketed(df, "few_files", "ds", "id", ("id", "cdc_time"), 8)
    assert spark.table("few_files").select(F.input_file_name()).distinct().count() <= 24


def test_poll_changes_job(spark, tmp_dir):
    from tidemark.plans import jobs
    url, opts = "jdbc:derby:memory:polldb;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}

    def put(lo, hi):
        spark.range(lo, hi).select(
            F.col("id").alias("change_id"), F.lit("users").alias("table_name"), F.col("id").alias("record_id"),
            F.lit("I").alias("operation"), F.lit("").alias("old_data"),
            F.concat(F.lit('{"id": '), "id", F.lit("}")).alias("new_data"),
            F.lit("2025-10-01 10:00:00").cast("timestamp").alias("change_time")
        ).write.format("jdbc").option("url", url).option("dbtable", "poll_log").options(**opts).mode("append").save()

    out, cursor = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "cursor")
    put(1, 51)
    assert jobs.poll_changes_job(spark, url, "poll_log", out, cursor, opts) == (0, 50)
    put(51, 61)
    assert jobs.poll_changes_job(spark, url, "poll_log", out, cursor, opts) == (50, 60)
    assert jobs.poll_changes_job(spark, url, "poll_log", out, cursor, opts) == (60, 60)
    got = spark.read.json(out)
    assert got.count() == 60 and got.select("CHANGE_ID" if "CHANGE_ID" in got.columns else "change_id").distinct().count() == 60
