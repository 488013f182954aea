"""Registered queries over mechanisms that keep data up to date: reports
maintained from changes, streams with state, stores that are written and
asked again.  Their SQL is in ``plans.oracle``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions import text as T
from tidemark.operators import analytics, changelog, differences, encode, kv, payloads, refresh, views
from tidemark.plans.base import AS_OF, PURGE_BEFORE, SNAPSHOT_OLD_END, STATE_CUTOFF, _scratch, _t, _ts
from tidemark.session import written
from tidemark.sinks import writers
from tidemark.sources import catalog, change_source
from tidemark.streaming import cdc_stream

AS_OF_TIMES = ["2024-01-05 00:00:00", "2024-01-15 12:00:00", "2024-01-31 00:00:00"]
REPORT_ROW = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
REPORT_KEYS = ["c_nationkey", "o_orderstatus"]
FEW_KEYS = 100


# --- a report from change rows -----------------------------------------------------------

def _report_snapshots(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Earlier and later orders: late ones are new, old fulfilled ones are
    archived, open ones are re-priced, some pending ones fulfilled."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    old = o.where(F.col("o_orderdate") < _ts(SNAPSHOT_OLD_END)).drop("o_orderdate")
    purged = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < _ts(PURGE_BEFORE))
    new = (o.where(~purged).drop("o_orderdate")
            .withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1)
                                         .otherwise(F.col("o_totalprice")))
            .withColumn("o_orderstatus", F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 11 == 0), "F")
                                          .otherwise(F.col("o_orderstatus"))))
    return old, new


def q_report_from_changes(spark, sf):
    """The rollup of the later orders from the earlier ones and the change
    rows between them, in four batches; the second one is delivered twice, and
    the first one again after it was folded into the base."""
    old, new = _report_snapshots(_t(spark, sf, "orders"))
    path = _scratch(spark, "report")
    of_customer = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    cents = {"cents": F.round(F.col("o_totalprice") * 100).cast("bigint")}

    def apply(signed: DataFrame, batch: int) -> None:
        partial = views.partial_groups(signed.join(of_customer, "o_custkey"), REPORT_KEYS, cents)
        views.apply_partial(partial, path, batch)

    apply(old.withColumn("_sign", F.lit(1)), 0)
    changes = written(changelog.diff_to_changelog(changelog.snapshot_diff(old, new, "o_orderkey"), "o_orderkey",
                                                  "orders", AS_OF), "report-changes")
    last = changes.agg(F.max("change_id")).scalar()
    part = F.ceil(F.col("change_id") * 4 / F.greatest(last, F.lit(1)))
    for batch in (1, 2, 2, 3):
        apply(views.signed_images(changes.where(part == batch), REPORT_ROW), batch)
    views.compact(spark, path, REPORT_KEYS, upto=2)
    for batch in (1, 4):
        apply(views.signed_images(changes.where(part == batch), REPORT_ROW), batch)
    groups = views.read_groups(spark, path, REPORT_KEYS).withColumnRenamed(views.COUNT, "n")
    return analytics.rollup_nations(groups, _t(spark, sf, "nation"), _t(spark, sf, "region"))


# --- streams with state ----------------------------------------------------------------

def _event_changes(events: DataFrame) -> DataFrame:
    op = (F.when(F.col("event_type") == "signup", fixed.OP_INSERT)
           .when(F.col("event_type") == "error", fixed.OP_DELETE).otherwise(fixed.OP_UPDATE))
    return events.select(
        (F.col("event_id") + 1).alias("change_id"), F.lit("events").alias("table_name"),
        F.col("user_id").alias("record_id"), op.alias("operation"),
        F.when(op != fixed.OP_INSERT, F.col("props")).alias("old_data"),
        F.when(op != fixed.OP_DELETE, F.col("props")).alias("new_data"),
        F.col("ts").cast("timestamp").alias("change_time"))


def q_stream_counters(spark, sf):
    """Changes counted by day and operation in two runs of one stream; every
    file is delivered twice, and the earlier ones again in the second run."""
    ev = _t(spark, sf, "events")
    land, path, checkpoint = (_scratch(spark, n) for n in ("counter-land", "counters", "counter-checkpoint"))
    late = F.col("ts") >= _ts(STATE_CUTOFF)
    for parts in ((~late, ~late), (late, late, ~late)):
        for part in parts:
            _event_changes(ev.where(part)).write.mode("append").parquet(land)
        unique = cdc_stream.unique_changes(cdc_stream.changelog_stream(spark, land, "parquet"))
        cdc_stream.keep_counters(cdc_stream.change_counters(unique), path, checkpoint, available_now=True).awaitTermination()
    out = cdc_stream.read_counters(spark, path)
    return out.select(T.time_text("window_start").alias("window_start"), "operation", "changes", "last_id")


def q_stream_change_table(spark, sf):
    """A change table read as a stream by offsets of its ids, in two runs of
    one checkpoint with rows appended in between; landed batch by batch."""
    ev = _t(spark, sf, "events")
    log, path, checkpoint = (_scratch(spark, n) for n in ("change-table", "changes-landed", "change-checkpoint"))
    change_source.register(spark)
    middle = ev.agg(F.percentile_approx("event_id", 0.6)).scalar()
    early = F.col("event_id") <= middle
    for part in (early, ~early):
        _event_changes(ev.where(part)).repartitionByRange(4, "change_id").write.mode("append").parquet(log)
        changes = (spark.readStream.format(change_source.FORMAT).schema(changelog.CHANGELOG_SCHEMA)
                        .option("rowsperpartition", 20_000).load(log))
        cdc_stream.land_batches(changes, path, checkpoint).awaitTermination()
    return spark.read.parquet(path).groupBy("operation").agg(
        F.count(F.lit(1)).alias("n"), F.sum("change_id").alias("id_sum"), F.min("change_id").alias("first_id"),
        F.max("change_id").alias("last_id"), F.count("old_data").alias("n_old"), F.count("new_data").alias("n_new"))


# --- copies and stores ---------------------------------------------------------------------

def q_copy_differences(spark, sf):
    """Orders against a copy in key order in which a stretch of prices is
    stale, the last keys are missing and some were put in by hand."""
    o = _t(spark, sf, "orders")
    ends = o.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).first()
    low, width = ends["low"] or 0, (ends["high"] or 0) - (ends["low"] or 0) + 1
    k = F.col("o_orderkey")
    stale = (k - low >= width // 4) & (k - low < width // 4 + width // 200)
    copy = (o.where(k - low < width - width // 500)
             .withColumn("o_totalprice", F.when(stale & (k % 3 == 0), F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice"))))
    by_hand = o.where(k - low < width // 1000 + 1).withColumn("o_orderkey", k + width)
    copy = written(copy.unionByName(by_hand).repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey"), "orders-copy")
    return differences.differing_keys(o, copy, "o_orderkey").withColumnRenamed("key", "o_orderkey")


def q_bucketed_join(spark, sf):
    """Orders and their lines from tables of the same buckets: joined and
    grouped by order without a shuffle."""
    names = {}
    for source, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        names[source] = f"{source}_{uuid.uuid4().hex}"
        writers.write_bucketed(_t(spark, sf, source), names[source], _scratch(spark, f"bucketed-{source}"), key)
    o, li = (spark.table(names[n]) for n in ("orders", "lineitem"))
    out = (li.join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
                                        F.max("o_totalprice").alias("o_totalprice"), F.max("o_orderstatus").alias("o_orderstatus")))
    for name in names.values():
        catalog.drop_table(spark, name)  # the files stay, and the plan reads them
    return out


def q_point_reads(spark, sf):
    """Orders by row key: a few keys, half of them absent, and many keys."""
    o = _t(spark, sf, "orders")
    rows = o.select(T.time_text("o_orderdate", "yyyyMM").alias("partition_date"),
                    T.row_key(T.day_key("o_orderdate"), "o_orderkey").alias("rowkey"), "o_orderkey", "o_totalprice")
    path = _scratch(spark, "point-store")
    writers.write_kv_partitioned(spark, rows, path, bloom_keys=100_000)
    store = spark.read.schema(rows.schema).parquet(path)
    few = rows.where(F.col("o_orderkey") < FEW_KEYS)
    few = few.select("rowkey").unionByName(few.select(F.concat("rowkey", F.lit("0x")).alias("rowkey")))
    many = rows.where(F.col("o_orderkey") % 3 == 0).select("rowkey")
    month = F.substring("rowkey", 1, 6)
    return reduce_union([kv.multi_get(store, keys, key_day=month).withColumn("asked", F.lit(n))
                         for n, keys in (("few", few), ("many", many))]).select("asked", "rowkey", "o_orderkey", "o_totalprice")


def reduce_union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_pruned_days(spark, sf):
    """Events by day partition joined to the days of a filtered calendar:
    days that the calendar leaves out are not read."""
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type", T.time_text("ts", fixed.DATE_TEXT_FORMAT).alias("ds"))
    fact, days = _scratch(spark, "events-by-day"), _scratch(spark, "calendar")
    ev.repartition("ds").write.partitionBy("ds").parquet(fact)
    day = F.to_date("ds")
    ev.select("ds").distinct().select("ds", F.weekday(day).alias("weekday"), F.dayofmonth(day).alias("day_no")).write.parquet(days)
    calendar = spark.read.parquet(days).where(F.col("weekday") >= 5)
    events = spark.read.schema(ev.schema).parquet(fact)
    return (analytics.of_days(events, calendar, "ds").groupBy("ds", "weekday")
            .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users")))


def q_cells_as_of(spark, sf):
    """The value of every events cell as of three times; null before its first."""
    ev = _t(spark, sf, "events").select(T.row_key("user_id", "event_type").alias("rowkey"), "ts", "event_id", "value")
    times = F.explode(F.array(*[_ts(t) for t in AS_OF_TIMES])).alias("as_of")
    asked = ev.select("rowkey").distinct().select("rowkey", times)
    out = kv.as_of(ev, asked, "rowkey", "ts", "as_of", "event_id")
    return out.select("rowkey", T.time_text("as_of").alias("as_of"), "event_id", "value", T.time_text("ts").alias("ts"))


# --- payloads, sketches, split ------------------------------------------------------------------

def _payloads(spark, sf) -> DataFrame:
    """Event properties, and order images in which pending orders carry their
    price as text and only open ones a priority."""
    o = _t(spark, sf, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    plain = F.to_json(F.struct("o_orderkey", price.alias("price"),
                               F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("priority")))
    as_text = F.to_json(F.struct("o_orderkey", price.cast("string").alias("price")))
    orders = o.select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"),
                      F.when(F.col("o_orderstatus") == "P", as_text).otherwise(plain).alias("payload"))
    return orders.unionByName(_t(spark, sf, "events").select(F.lit("events").alias("source"), F.col("event_id").alias("id"),
                                                             F.col("props").alias("payload")))


def q_payload_drift(spark, sf):
    return payloads.drift_report(_payloads(spark, sf), "payload", ["source"])


def q_payload_typed(spark, sf):
    """Both payloads as columns of the type that all of them fit."""
    typed = payloads.typed_payload(_payloads(spark, sf), "payload", "p")
    price = F.col("p.price").cast("string")
    return typed.select("source", "id", F.col("p.k").cast("bigint").alias("k"), F.col("p.o_orderkey").cast("bigint").alias("o_orderkey"),
                        F.col("p.priority").alias("priority"), F.round(price.cast("double"), 2).alias("price"))


def q_sketch_coverage(spark, sf):
    """Users by week from daily sketches, against the exact number: within
    four standard errors of the sketch."""
    ev = _t(spark, sf, "events").select(T.time_text("ts", fixed.DATE_TEXT_FORMAT).alias("ds"), "user_id", "event_type")
    daily = written(refresh.coverage_sketches(ev, ["ds", "event_type"], "user_id"), "daily-sketches")
    week = F.date_trunc("week", F.to_date("ds")).cast("date").cast("string").alias("week")
    merged = refresh.merged_coverage(daily.select(week, "sketch", "n_rows"), ["week"])
    exact = ev.select(week, "user_id").groupBy("week").agg(F.count_distinct("user_id").alias("n_users"))
    near = F.abs(F.col("keys_estimate") - F.col("n_users")) <= F.ceil(4 * 1.04 / 64 * F.col("n_users"))
    return merged.join(exact, "week").select("week", "n_rows", "n_users", near.alias("within_bound"))


def q_exact_split(spark, sf):
    """Set sizes of the exact split, and how many sets a row is in."""
    s = encode.exact_split(_t(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_ids"))


# --- topics, refresh cycles, statements -------------------------------------------------------

LOADED_ROW = "k bigint, cdc_time string, original_change_id bigint, original_operation string, operation string"


def q_topic_load(spark, sf):
    """Changes as JSON records of a topic (files stand in for it), loaded in
    two micro-batch runs into a table by batch and day."""
    ev = _t(spark, sf, "events")
    topic, path, metrics, checkpoint = (_scratch(spark, n) for n in ("topic", "topic-table", "topic-metrics", "topic-checkpoint"))
    name = f"topic_{uuid.uuid4().hex}"
    late = F.col("ts") >= _ts(STATE_CUTOFF)
    for part in (~late, late):
        flat = changelog.flatten(_event_changes(ev.where(part)), cdc_time=_ts(AS_OF))
        records = flat.select("doc", "change_id")
        (writers.as_topic_records(records.select(F.col("doc").alias("document"), "change_id"), key_col="change_id")
                .write.mode("append").json(topic))
        messages = (spark.readStream.schema("key string, value string").json(topic)
                         .select(F.from_json("value", "document string, change_id bigint").alias("m")).select(
                             F.col("m.document").alias("doc"), F.col("m.change_id").alias("change_id")))
        cdc_stream.load_batches(messages, name, metrics, checkpoint, LOADED_ROW, key_col="k", available_now=True,
                                path=path).awaitTermination()
    rows = spark.read.schema(spark.table(name).schema).parquet(path)
    catalog.drop_table(spark, name)  # the files stay
    counted = cdc_stream.batch_counters(spark, metrics).agg(F.max("cumulative_rows").alias("n_counted"))
    loaded = rows.groupBy(F.coalesce("original_operation", "operation").alias("operation"), "ds").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("k_sum"), F.max("original_change_id").alias("last_id"))
    return loaded.withColumn("n_counted", F.lit(counted.first()["n_counted"]).cast("bigint"))


CYCLES = ["2024-01-10 00:00:00", "2024-01-10 00:30:00", "2024-01-20 00:00:00", "2024-01-31 00:00:00"]
CYCLE_SECONDS = 3600


def _fetched(spark, events: DataFrame) -> DataFrame:
    """Events as fetch results of the pairs; an error is a failed fetch, and
    every sixth pair fails in the first ten days."""
    pairs = refresh.pairs_frame(spark).select(F.col("base").alias("base_currency"), F.col("target").alias("target_currency"))
    rank = F.row_number().over(Window.orderBy("base_currency", "target_currency")) - 1   # 18 fixed rows
    pairs = pairs.withColumn("pair", rank)
    early = F.col("ts") < _ts(CYCLES[0])
    failed = (F.col("event_type") == "error") | (early & (F.col("pair") % 6 == 2))
    return (events.withColumn("pair", F.pmod("event_id", F.lit(18)).cast("int")).join(F.broadcast(pairs), "pair")
                  .select("base_currency", "target_currency", F.when(~failed, F.col("value")).alias("rate"),
                          F.col("ts").alias("fetched_at")))


def q_refresh_cycles(spark, sf):
    """Four cycles of the rate refresh over landed fetch results, many of a
    pair in each; the second one comes too early for any pair, and the last one
    is run again after a failure before its commit."""
    fetched = written(_fetched(spark, _t(spark, sf, "events")), "fetched")
    base, log = _scratch(spark, "rates"), _scratch(spark, "rate-changes")
    before = "1900-01-01 00:00:00"
    for now in CYCLES:
        landed = fetched.where((F.col("fetched_at") >= _ts(before)) & (F.col("fetched_at") < _ts(now)))
        for attempt in (0, 1) if now == CYCLES[-1] else (1,):
            stored = writers.read_state(spark, base, refresh.RATE_STATE_SCHEMA)
            out = refresh.refresh_rates(spark, stored, landed, _ts(now), CYCLE_SECONDS)
            if attempt:
                writers.commit_with(spark, out["new_state"], base, {log: out["changes"]})
            else:  # written, not committed
                version = writers.current_version(spark, base) + 1
                out["changes"].write.json(f"{log}/state_version={version}")
        before = now
    changes = spark.read.schema("base_currency string, target_currency string, exchange_rate double, update_time string, "
                                "is_fallback boolean").json(log)
    return changes.select("base_currency", "target_currency", F.round("exchange_rate", 6).alias("exchange_rate"), "update_time",
                          F.coalesce("is_fallback", F.lit(False)).alias("is_fallback"))


def q_preview_orders(spark, sf):
    """The first rows of a table for display, in the order of the key."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return writers.preview(o.orderBy(F.desc("o_totalprice"), "o_orderkey"))


def q_catalog_statements(spark, sf):
    """A database and a table are made twice and filled once; what the
    statements say, and the table's rows before it is dropped."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    home = spark.catalog.currentDatabase()
    name = f"db_{uuid.uuid4().hex}"
    try:
        for _ in range(2):
            catalog.create_database(spark, name)
        made = [catalog.create_table_if_absent(spark, f"{name}.customers", c) for _ in range(2)]
        c.write.insertInto(f"{name}.customers")
        listed = catalog.show_databases(spark).where(F.col("namespace") == name).count()
        rows = spark.table(f"{name}.customers").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("c_custkey").alias("key_sum")).first()
        version = catalog.engine_version(spark).first()["version"]
        catalog.drop_table(spark, f"{name}.customers")
        left = spark.catalog.tableExists(f"{name}.customers")
    finally:
        spark.catalog.setCurrentDatabase(home)
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return spark.createDataFrame([(made[0], made[1], listed, rows["n_rows"], rows["key_sum"], bool(version), left)],
                                 "made boolean, made_again boolean, databases long, n_rows long, key_sum long, "
                                 "has_version boolean, left_behind boolean")


UPKEEP = {
    "topic_load": q_topic_load,
    "refresh_cycles": q_refresh_cycles,
    "preview_orders": q_preview_orders,
    "catalog_statements": q_catalog_statements,
    "report_from_changes": q_report_from_changes,
    "stream_counters": q_stream_counters,
    "stream_change_table": q_stream_change_table,
    "copy_differences": q_copy_differences,
    "bucketed_join": q_bucketed_join,
    "point_reads": q_point_reads,
    "pruned_days": q_pruned_days,
    "cells_as_of": q_cells_as_of,
    "payload_drift": q_payload_drift,
    "payload_typed": q_payload_typed,
    "sketch_coverage": q_sketch_coverage,
    "exact_split": q_exact_split,
}
