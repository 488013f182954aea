"""Reports from changes, streams with state, comparison of copies, stores
that are asked again."""

import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import analytics, changelog, differences, encode, kv, payloads, refresh, views
from tidemark.sinks import writers
from tidemark.sources import change_source
from tidemark.streaming import cdc_stream


def scans(df):
    """(partitions read, rows that left the scan) of each file scan of a collected frame."""
    def go(plan):
        name = plan.getClass().getSimpleName()
        if "Adaptive" in name:
            yield from go(plan.executedPlan())
        elif "QueryStage" in name:
            yield from go(plan.plan())
        elif "FileSourceScan" in name:
            m = plan.metrics()
            yield m.apply("numPartitions").value() if m.contains("numPartitions") else 1, m.apply("numOutputRows").value()
        elif plan.children().isEmpty() is False:
            for i in range(plan.children().size()):
                yield from go(plan.children().apply(i))

    return list(go(df._jdf.queryExecution().executedPlan()))


# --- reports from changes -----------------------------------------------------------

def _image(row):
    return None if row is None else '{"id": %d, "g": "%s", "v": %d}' % row


def _change(i, old, new):
    op = "I" if old is None else "D" if new is None else "U"
    return (i, "t", (old or new)[0], op, _image(old), _image(new), None)


def test_report_follows_changes(spark, tmp_dir):
    rnd = random.Random(3)
    now, log = {}, []
    for i in range(1, 301):
        k = rnd.randrange(40)
        old = now.get(k)
        new = None if old and rnd.random() < 0.3 else (k, rnd.choice("abcd"), rnd.randrange(100))
        log.append(_change(i, old, new))
        now.pop(k, None)
        if new:
            now[k] = new
    df = spark.createDataFrame(log, changelog.CHANGELOG_SCHEMA)

    def apply(b):
        part = df.where(F.expr(f"change_id > {b * 60} and change_id <= {b * 60 + 60}"))
        signed = views.signed_images(part, "id bigint, g string, v bigint")
        views.apply_partial(views.partial_groups(signed, ["g"], {"v": F.col("v")}), tmp_dir, b)

    got = lambda: {r.g: (r.n_rows, r.v) for r in views.read_groups(spark, tmp_dir, ["g"]).collect()}
    for b in (0, 1, 1, 2):
        apply(b)
    views.compact(spark, tmp_dir, ["g"], 1)
    # a base that was written but not committed is not used
    spark.createDataFrame([("z", 9, 9)], "g string, n_rows bigint, v bigint").write.parquet(f"{tmp_dir}/base/v=3")
    for b in (0, 3, 4, 2):
        apply(b)
    want = defaultdict(lambda: [0, 0])
    for _, g, v in now.values():
        want[g][0] += 1
        want[g][1] += v
    assert got() == {g: tuple(x) for g, x in want.items()}
    views.compact(spark, tmp_dir, ["g"], 4)
    assert got() == {g: tuple(x) for g, x in want.items()}


def test_report_batch_touches_its_groups_only(spark, tmp_dir):
    groups = spark.range(1000).select(F.lit(1).alias("_sign"), F.col("id").alias("g"), F.lit(5).alias("v"))
    views.apply_partial(views.partial_groups(groups, ["g"], {"v": F.col("v")}), tmp_dir, 0)
    one = spark.createDataFrame([(-1, 7, 5)], "_sign int, g long, v int")
    views.apply_partial(views.partial_groups(one, ["g"], {"v": F.col("v")}), tmp_dir, 1)
    assert spark.read.parquet(f"{tmp_dir}/batches/batch=1").count() == 1
    left = views.read_groups(spark, tmp_dir, ["g"])
    assert left.count() == 999 and left.where("g = 7").isEmpty()   # its count fell to 0


# --- streams --------------------------------------------------------------------------

def _changes(spark, ids, day=1):
    return spark.createDataFrame([(i, "t", i, "I", None, f'{{"i": {i}}}') for i in ids],
                                 "change_id bigint, table_name string, record_id bigint, operation string, old_data string, "
                                 "new_data string").withColumn("change_time", F.expr(
                                     f"timestamp'2024-01-0{day} 00:00:00' + make_interval(0, 0, 0, 0, 0, change_id)"))


def test_counters_of_changes_delivered_again(spark, tmp_dir):
    land, path, ck = (os.path.join(tmp_dir, x) for x in ("land", "out", "ck"))

    def run():
        unique = cdc_stream.unique_changes(cdc_stream.changelog_stream(spark, land, "parquet"))
        cdc_stream.keep_counters(cdc_stream.change_counters(unique), path, ck, available_now=True).awaitTermination()
        return {r.window_start.day: r.changes for r in cdc_stream.read_counters(spark, path).collect()}

    first, second = _changes(spark, range(1, 50)), _changes(spark, range(50, 80), day=5)
    for _ in range(2):
        first.write.mode("append").parquet(land)
    assert run() == {1: 49}
    second.write.mode("append").parquet(land)
    first.write.mode("append").parquet(land)      # far behind the watermark after this batch
    assert run() == {1: 49, 5: 30}
    first.write.mode("append").parquet(land)
    assert run() == {1: 49, 5: 30}


def test_change_source_goes_on_after_a_failure(spark, tmp_dir):
    log, out, ck = (os.path.join(tmp_dir, x) for x in ("log", "out", "ck"))
    change_source.register(spark)
    stream = lambda: (spark.readStream.format("changes").schema(changelog.CHANGELOG_SCHEMA)
                           .option("rowsPerPartition", 40).load(log))
    parts = []

    def run(fail=False):
        def handle(batch, batch_id):
            parts.append(batch.rdd.getNumPartitions())
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            if fail:
                raise RuntimeError("after writing, before the commit")
        stream().writeStream.foreachBatch(handle).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()

    _changes(spark, range(1, 201)).repartitionByRange(5, "change_id").write.mode("append").parquet(log)
    run()
    _changes(spark, range(201, 301)).repartitionByRange(2, "change_id").write.mode("append").parquet(log)
    with pytest.raises(Exception, match="after writing"):
        run(fail=True)
    _changes(spark, range(301, 321)).write.mode("append").parquet(log)
    run()
    run()
    ids = [r.change_id for r in spark.read.parquet(out).select("change_id").collect()]
    assert sorted(ids) == list(range(1, 321))
    assert parts[:2] == [5, 2]


def test_change_source_prunes_row_groups(spark, tmp_dir):
    spark.range(1, 1001).withColumnRenamed("id", "change_id").repartitionByRange(8, "change_id").write.parquet(tmp_dir + "/t")
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([StructField("change_id", LongType())])
    reader = change_source.ChangeReader(schema, {"path": tmp_dir + "/t", "rowsperpartition": "100000"})
    assert reader.latestOffset() == {"id": 1000}
    parts = reader.partitions({"id": 990}, {"id": 1000})
    assert len(parts) == 1 and len(parts[0].pieces) == 1           # one of eight files
    assert sorted(x for b in reader.read(parts[0]) for x in b.column(0).to_pylist()) == list(range(991, 1001))
    assert reader.partitions({"id": 1000}, {"id": 1000}) == []
    assert change_source.ChangeReader(schema, {"path": tmp_dir + "/none"}).latestOffset() == {"id": 0}


# --- copies -------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_differing_keys_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, rnd.randrange(-500, 50_000)]) if rnd.random() < 0.01 else rnd.randrange(-500, 50_000),
             rnd.randrange(5)) for _ in range(3000)]
    other = [(k, v + 1 if rnd.random() < 0.01 else v) for k, v in rows if rnd.random() > 0.01] + [(60_000, 1), (None, 7)]
    a, b = (spark.createDataFrame(x, "k long, v int") for x in (rows, other))
    group = lambda x: {k: Counter(v for kk, v in x if kk == k) for k, _ in x}
    x, y = group(rows), group(other)
    want = {(k, "missing" if k not in y else "added" if k not in x else "changed") for k in {*x, *y} if x.get(k) != y.get(k)}
    got = [tuple(r) for r in differences.differing_keys(a, b, "k", fanout=8, leaf_keys=64).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_only_unequal_ranges_are_read_again(spark, tmp_dir):
    spark.range(200_000).withColumn("v", F.col("id") % 7).repartitionByRange(16, "id").sortWithinPartitions("id").write.parquet(tmp_dir + "/a")
    a = spark.read.parquet(tmp_dir + "/a")
    b = a.withColumn("v", F.when(F.col("id") == 123_456, -1).otherwise(F.col("v")))
    levels = []
    got = differences.differing_keys(a, b, "id", fanout=16, leaf_keys=1000, levels=levels)
    assert [tuple(r) for r in got.collect()] == [(123_456, "changed")]
    assert [n for _, n in levels] == [1, 1]
    assert differences.differing_keys(a, a, "id").isEmpty()
    none = a.limit(0)
    assert differences.differing_keys(none, none, "id").isEmpty()
    assert {r.difference for r in differences.differing_keys(none, a.limit(3), "id").collect()} == {"added"}
    text = differences._within(a, "id", [7], 0, 12_500)
    text.collect()
    assert scans(text)[0][1] < 60_000     # files of other ranges are left out


# --- stores ----------------------------------------------------------------------------------

def test_bucketed_join_has_no_exchange(spark, tmp_dir):
    a = spark.range(1000).select(F.col("id").alias("a"), (F.col("id") * 2).alias("x"))
    b = spark.range(3000).select((F.col("id") % 1000).alias("b"), F.lit(1).alias("y"))
    for df, name, key in ((a, "bj_a", "a"), (b, "bj_b", "b")):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        writers.write_bucketed(df, name, f"{tmp_dir}/{name}", key, n_buckets=4)
    joined = (spark.table("bj_a").hint("merge").join(spark.table("bj_b"), F.col("a") == F.col("b"))
                   .groupBy("a").agg(F.sum("y").alias("n")))
    for name in ("bj_a", "bj_b"):
        spark.sql(f"DROP TABLE {name}")
    assert {r.n for r in joined.collect()} == {3} and joined.count() == 1000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_point_reads_skip_row_groups(spark, tmp_dir):
    rows = spark.range(4000).select(F.lit("202401").alias("partition_date"), F.concat(F.lit("k"), F.sha1(F.col("id").cast("string"))).alias("rowkey"), "id")
    writers.write_kv_partitioned(spark, rows, tmp_dir + "/kv", files_per_day=4, bloom_keys=4000)
    store = spark.read.schema(rows.schema).parquet(tmp_dir + "/kv")
    here = rows.where("id in (3, 77)").select("rowkey")
    got = kv.multi_get(store, here.unionByName(here))
    assert sorted(r.id for r in got.collect()) == [3, 77]
    # absent keys inside the bounds of the files: the Bloom filters answer
    absent = kv.multi_get(store, here.select(F.concat("rowkey", F.lit("x")).alias("rowkey")))
    assert absent.collect() == [] and sum(n for _, n in scans(absent)) == 0
    writers.write_kv_partitioned(spark, rows, tmp_dir + "/plain", files_per_day=4)
    plain = kv.multi_get(spark.read.schema(rows.schema).parquet(tmp_dir + "/plain"), here.select(F.concat("rowkey", F.lit("x")).alias("rowkey")))
    assert plain.collect() == [] and sum(n for _, n in scans(plain)) > 0
    many = kv.multi_get(store, rows.where("id % 2 = 0").select("rowkey"))
    assert many.count() == 2000
    assert kv.multi_get(store, here.limit(0)).isEmpty()


def test_last_put_of_a_key_counts(spark, tmp_dir):
    rows = [("202401", "k", float(i), i) for i in range(40)] + [("202401", "other", 1.0, 0)]
    for n in (1, 3, 7):
        df = spark.createDataFrame(rows, "partition_date string, rowkey string, v double, put int").repartition(n)
        writers.write_kv_partitioned(spark, df, f"{tmp_dir}/{n}", order_cols="put")
        assert {(r.rowkey, r.v) for r in spark.read.parquet(f"{tmp_dir}/{n}").collect()} == {("k", 39.0), ("other", 1.0)}


def test_day_table_prunes_partitions(spark, tmp_dir):
    spark.range(300).select("id", F.concat(F.lit("d"), (F.col("id") % 30).cast("string")).alias("ds")).write.partitionBy("ds").parquet(tmp_dir + "/f")
    spark.range(30).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("ds"), F.col("id").alias("n")).write.parquet(tmp_dir + "/d")
    out = analytics.of_days(spark.read.parquet(tmp_dir + "/f"), spark.read.parquet(tmp_dir + "/d").where("n < 2"), "ds")
    assert len(out.collect()) == 20
    assert "dynamicpruning" in out._jdf.queryExecution().toString().lower()
    assert [n for n, _ in scans(out) if n > 1] == [2]    # of 30 days


def test_cells_as_of_against_brute_force(spark):
    rnd = random.Random(9)
    stamp = lambda h: f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00"
    cells = [("hot" if rnd.random() < 0.5 else rnd.choice("abc"), stamp(rnd.randrange(240)), i, i * 1.5) for i in range(400)]
    asked = [(rnd.choice(["hot", "a", "b", "c", "none"]), stamp(rnd.randrange(240)), j) for j in range(200)] * 2
    v = spark.createDataFrame(cells, "k string, t string, n long, x double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    q = spark.createDataFrame(asked, "k string, at string, j long").withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = Counter((r.k, str(r["at"]), r.j, r.n) for r in kv.as_of(v, q, "k", "t", "at", "n", block_seconds=36_000).collect())
    want = Counter()
    for k, at, j in asked:
        best = max(((t, n) for kk, t, n, _ in cells if kk == k and t <= at), default=(None, None))
        want[(k, at, j, best[1])] += 1
    assert got == want


# --- payloads, sketches, split -----------------------------------------------------------------

def test_payload_types(spark):
    rows = [('{"a": 1, "b": "x"}',), ('{"a": 2.5, "c": {"d": true}}',), ('{"b": 7}',), (None,), ("no json",), ('{"e": null}',)]
    df = spark.createDataFrame(rows, "p string")
    typed = payloads.typed_payload(df, "p", "o")
    fields = {f.name: f.dataType.simpleString() for f in typed.schema["o"].dataType}
    assert fields["a"].startswith("decimal") and fields["b"] == "variant" and fields["c"] == "struct<d:boolean>" and fields["e"] == "string"
    got = [(r.a and float(r.a), r.d) for r in typed.select("o.a", "o.c.d").collect()]
    assert got == [(1.0, None), (2.5, True), (None, None), (None, None), (None, None), (None, None)]
    drift = {(r.field, r.kind): (r.n_rows, r.drifts) for r in payloads.drift_report(df, "p").collect()}
    assert drift[("b", "STRING")] == (1, True) and drift[("b", "BIGINT")] == (1, True)
    assert drift[("e", "VOID")] == (1, False) and drift[("c", "OBJECT")] == (1, False)
    assert payloads.typed_payload(df.limit(0), "p").isEmpty()


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 20_000).alias("user"))
    daily = refresh.coverage_sketches(df, ["day"], "user")
    got = refresh.merged_coverage(daily.withColumn("all", F.lit(1)), ["all"]).first()
    assert got.n_rows == 60_000 and abs(got.keys_estimate - 20_000) <= 4 * 1.04 / 64 * 20_000


@pytest.mark.parametrize("n,same", [(0, 0), (1, 0), (3, 0), (997, 0), (1000, 400), (50, 50)])
def test_exact_split(spark, n, same):
    rows = [(0, "same") if i < same else (i, str(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, t string")
    a = sorted(tuple(r) for r in encode.exact_split(df, "id").collect())
    b = sorted(tuple(r) for r in encode.exact_split(df.repartition(3), "id").collect())
    assert a == b and sorted(r[:2] for r in a) == sorted(rows)
    assert sum(r[2] == "eval" for r in a) == n * 20 // 100


# --- corrections ---------------------------------------------------------------------------------

def test_blank_lines_of_tabs(spark, tmp_dir):
    with open(tmp_dir + "/log.txt", "w") as f:
        f.write('{"a": 1}\n\t\n \t \n\n{"a": 2}\n')
    assert refresh.non_blank_lines(spark, tmp_dir + "/log.txt").first().lines == 2


def test_fetch_results_of_one_pair(spark):
    rows = [("USD", "CNY", r) for r in (None, 0.0, 2.0, 6.0, 4.0)] * 6
    state = spark.createDataFrame([], refresh.RATE_STATE_SCHEMA)
    now = F.lit("2025-10-01 10:00:00").cast("timestamp_ntz")
    for n in (1, 2, 5):
        snap = spark.createDataFrame(rows, refresh.RATE_SNAPSHOT_SCHEMA).repartition(n)
        out = refresh.refresh_rates(spark, state, snap, now, 3600)
        pair = "base_currency = 'USD' and target_currency = 'CNY'"
        assert [r.exchange_rate for r in out["changes"].where(pair).collect()] == [6.0]
        assert [r.rates["CNY"] for r in out["new_state"].where(pair).collect()] == [6.0]
