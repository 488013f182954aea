"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
built from the operators over the given tables.

Parameters shared by the queries are module constants so the matching
SQL in ``plans.oracle`` uses the same values.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions import text as T
from tidemark.functions import tokens as K
from tidemark.functions.compute import literal_table
from tidemark.operators import analytics, changelog, corpus, encode, kv, refresh, state
from tidemark.plans.base import (AS_OF, STATE_CUTOFF, REFRESH_INTERVAL, FRESH_INTERVAL, SCAN_DAY, SNAPSHOT_OLD_END, PURGE_BEFORE, SCAN_PREFIX, CDC_BATCH, EVENT_REF_VALUES, STORE_TABLES,
                                 _scratch, _t, _ts)
from tidemark.plans.upkeep import UPKEEP
from tidemark.session import written
from tidemark.sinks import writers
from tidemark.sources import catalog, files
from tidemark.sources.tables import register_views

# --- orders key-value store --------------------------------------------------

def q_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = kv.with_order_keys(_t(spark, sf, "orders"))
    return kv.status_counts(orders, "o_orderstatus")


def q_partition_scan(spark, sf):
    return kv.partition_scan(_t(spark, sf, "orders"), SCAN_DAY, 5).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "partition_date", "rowkey")


def q_rowkey_prefix_scan(spark, sf):
    return kv.prefix_scan(_t(spark, sf, "orders"), SCAN_PREFIX).select(
        "rowkey", "o_orderkey", "o_orderstatus", "o_totalprice")


def q_kv_mapped_view(spark, sf):
    o = kv.with_order_keys(_t(spark, sf, "orders"))
    src = o.select(F.col("plain_rowkey").alias("rowkey"),
                   F.col("o_orderkey").alias("order_id"),
                   T.time_text("o_orderdate").alias("create_time"),
                   F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"),
                   F.col("o_orderstatus").alias("status"), "partition_date")
    return kv.kv_view(src)


def q_kv_versions_top3(spark, sf):
    ev = _t(spark, sf, "events").select(
        T.row_key("user_id", "event_type").alias("rowkey"), "ts", "event_id", "value")
    top = kv.keep_versions(ev, "rowkey", "ts", tie_col="event_id")
    return top.select("rowkey", "version", "event_id", "value", T.time_text("ts").alias("ts"))


# --- change log ---------------------------------------------------------------

def events_as_changelog(events: DataFrame) -> DataFrame:
    """Events viewed as a change log: signup = insert, error = delete, other
    = update; ``props`` is the row image."""
    op = (F.when(F.col("event_type") == "signup", fixed.OP_INSERT)
           .when(F.col("event_type") == "error", fixed.OP_DELETE)
           .otherwise(fixed.OP_UPDATE))
    return events.select(
        F.col("event_id").alias("change_id"), F.lit("events").alias("table_name"),
        F.col("user_id").cast("int").alias("record_id"), op.alias("operation"),
        F.when(op != fixed.OP_INSERT, F.col("props")).alias("old_data"),
        F.when(op != fixed.OP_DELETE, F.col("props")).alias("new_data"),
        F.col("ts").alias("change_time"))


def q_cursor_read(spark, sf):
    ev = _t(spark, sf, "events")
    cursor = ev.where(F.col("ts") < _ts(STATE_CUTOFF)).agg(F.max("event_id")).scalar()
    rows = changelog.after_cursor(ev, cursor, "event_id")
    return rows.select("event_id", "user_id", "event_type", "value", T.time_text("ts").alias("ts"))


FLAT_CHECK_SCHEMA = ("original_change_id bigint, change_id bigint, source_db string, cdc_time string, "
                     "data_format string, original_operation string, original_table_name string, "
                     "k bigint, record_id int, old_data struct<k: bigint>")


def q_cdc_flatten(spark, sf):
    ch = events_as_changelog(_t(spark, sf, "events"))
    flat = changelog.flatten(ch, cdc_time=_ts(AS_OF))
    # parse each document once for the checked fields, once for its key count
    f = flat.select(F.from_json("doc", FLAT_CHECK_SCHEMA).alias("j"),
                    F.size(F.from_json("doc", "map<string,string>")).alias("n_fields"))
    return f.select(
        F.coalesce("j.original_change_id", "j.change_id").alias("change_id"),
        "j.source_db", "j.cdc_time", "j.data_format", "j.original_operation",
        "j.original_table_name", "j.k", "j.record_id", F.col("j.old_data.k").alias("old_k"),
        "n_fields")


def q_cdc_envelope(spark, sf):
    ch = events_as_changelog(_t(spark, sf, "events"))
    env = changelog.with_envelope(ch)
    j = F.from_json("envelope", "change_id bigint, table_name string, record_id int, operation string, "
                                "change_time string, old_data string, new_data string")
    return env.select(j.alias("e"), F.size(F.from_json("envelope", "map<string,string>")).alias("n_fields")) \
              .select(F.col("e.change_id").alias("change_id"), F.col("e.operation").alias("operation"),
                      F.col("e.record_id").alias("record_id"), F.col("e.table_name").alias("table_name"),
                      F.col("e.old_data").isNotNull().alias("has_old"),
                      F.col("e.new_data").isNotNull().alias("has_new"), "n_fields")


def _snapshots(orders: DataFrame):
    """Two snapshots of the order table: the earlier one holds orders placed
    before SNAPSHOT_OLD_END; the later one holds every order except
    fulfilled ones placed before PURGE_BEFORE (archived), with open orders
    re-priced.  Their diff has inserts, deletes and updates."""
    o = orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    old = o.where(F.col("o_orderdate") < _ts(SNAPSHOT_OLD_END)).drop("o_orderdate")
    purged = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < _ts(PURGE_BEFORE))
    new = (o.where(~purged)
            .withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1)
                                         .otherwise(F.col("o_totalprice")))
            .drop("o_orderdate"))
    return old, new


def q_snapshot_diff(spark, sf):
    old, new = _snapshots(_t(spark, sf, "orders"))
    d = changelog.snapshot_diff(old, new, "o_orderkey")
    return d.select("o_orderkey", "operation",
                    F.col("old_row.o_totalprice").alias("old_price"),
                    F.col("new_row.o_totalprice").alias("new_price"))


def q_cdc_batch_metrics(spark, sf):
    ev = _t(spark, sf, "events").select("event_id")
    return changelog.batch_metrics(ev, "event_id", CDC_BATCH)


def q_lenient_load(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    raw = o.select(
        k,
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit("n/a"))
         .otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")).alias("amount"),
        F.when(F.pmod(k, F.lit(19)) == 0, F.lit("2024-13-45 99:99:99"))
         .otherwise(T.time_text("o_orderdate")).alias("order_time"),
        F.when(F.pmod(k, F.lit(23)) != 0, F.lit("sqlserver")).alias("source_db"),
        F.when(F.pmod(k, F.lit(29)) != 0, F.col("o_orderdate")).alias("cdc_time"))
    typed = changelog.lenient_cast(raw, {"amount": "bigint",
                                         "order_time": ("timestamp", fixed.TIME_TEXT_FORMAT)})
    filled = changelog.with_defaults(typed, {"source_db": fixed.SOURCE_DB, "cdc_time": _ts(AS_OF)})
    return filled.select("o_orderkey", F.col("amount").alias("amount_cents"),
                         T.time_text("order_time").alias("order_time"), "source_db",
                         T.time_text("cdc_time").alias("cdc_time"))


def q_retention_window(spark, sf):
    ev = _t(spark, sf, "events")
    kept = changelog.retention_filter(ev, "ts", _ts(AS_OF))
    return kept.groupBy(T.time_text("ts", fixed.DATE_TEXT_FORMAT).alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users"))


def q_multi_source_union(spark, sf):
    c = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    s = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return changelog.merge_sources({"customer": c, "supplier": s})


# --- keyed state ----------------------------------------------------------------

KEYS = ["user_id", "event_type"]


def _state_and_batch(spark, sf):
    ev = _t(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    st = state.latest_per_key(ev.where(F.col("ts") < _ts(STATE_CUTOFF)), KEYS, ["ts", "event_id"])
    batch = ev.where(F.col("ts") >= _ts(STATE_CUTOFF))
    return ev, st, batch


def q_upsert_latest(spark, sf):
    _, st, batch = _state_and_batch(spark, sf)
    up = state.upsert(st, batch, KEYS, ["ts", "event_id"])
    return up.select(*KEYS, "event_id", "value", T.time_text("ts").alias("ts"), "origin")


def q_upsert_accounting(spark, sf):
    _, st, batch = _state_and_batch(spark, sf)
    return state.upsert_accounting(st, batch, KEYS)


def _due(spark, sf):
    ev = _t(spark, sf, "events").select(*KEYS, "ts")
    keys = ev.select(*KEYS).distinct()
    last = (ev.where(F.col("ts") < _ts(STATE_CUTOFF)).groupBy(*KEYS)
              .agg(F.max("ts").alias("last_seen")))
    return state.due_keys(keys, last, KEYS, "last_seen", _ts(STATE_CUTOFF), REFRESH_INTERVAL)


def q_due_keys(spark, sf):
    return _due(spark, sf).select(*KEYS, T.time_text("last_seen").alias("last_seen"), "reason", "due")


def q_cycle_counts(spark, sf):
    return state.cycle_counts(_due(spark, sf))


def _event_ref(spark):
    return literal_table(spark, list(EVENT_REF_VALUES.items()), "event_type string, ref_value double")


def _imputed(spark, sf):
    ev = _t(spark, sf, "events")
    missing = ev.withColumn("value", F.when(F.pmod("event_id", F.lit(10)) != 0, F.col("value")))
    return state.impute(missing, "value", _event_ref(spark), "event_type", "ref_value",
                        random_key=F.col("event_id"))


def q_fallback_impute(spark, sf):
    return _imputed(spark, sf).select("event_id", "event_type", "value", "is_fallback", "source")


def q_change_projection(spark, sf):
    ev = _t(spark, sf, "events").withColumn("rates", F.from_json("props", "map<string,double>"))
    pr = state.project_change(ev, "rates", F.lit("k"), _ts(AS_OF))
    return pr.select("event_id", "event_type", "exchange_rate",
                     T.time_text("ts").alias("timestamp"), "update_time", "is_fallback")


def q_state_stats(spark, sf):
    ev = _t(spark, sf, "events")
    st = state.latest_per_key(_imputed(spark, sf).select(*KEYS, "event_id", "ts", "is_fallback"),
                              KEYS, ["ts", "event_id"])
    dim = (ev.agg(F.count_distinct("user_id")).scalar() *
           ev.agg(F.count_distinct("event_type")).scalar())
    return refresh.state_stats(st, KEYS, "ts", "is_fallback", _ts(AS_OF), FRESH_INTERVAL, dim, keys_unique=True)


def q_success_rate(spark, sf):
    ev = _t(spark, sf, "events")
    return refresh.success_rate(ev, "user_id", F.col("event_type") == "error")


def q_pair_expansion(spark, sf):
    docs = _t(spark, sf, "documents").select(
        "doc_id", F.create_map(F.col("lang"), F.split("text", "\n")).alias("lines"))
    ex = refresh.expand_pairs(docs, "lines", "base", "target")
    return ex.select("doc_id", "base", "item_pos", F.length("target").alias("target_chars"))


def q_nonblank_lines(spark, sf):
    docs = _t(spark, sf, "documents").select("lang", "text")
    return refresh.count_non_blank_lines(docs, "text", ["lang"])


def _customer_addresses(spark, sf):
    cust = _t(spark, sf, "customer").select("c_custkey")
    dim = corpus.address_dimension(spark)
    # 10-row literal dimension with exact size statistics: Spark broadcasts it
    j = cust.join(dim, F.pmod("c_custkey", F.lit(10)) == F.col("addr_idx"))
    return j.select("c_custkey",
                    F.concat("address", F.col("c_custkey").cast("string"), F.lit("号")).alias("address"),
                    "province", "city", "district", "street")


def q_region_derive(spark, sf):
    a = _customer_addresses(spark, sf)
    r = a.select("c_custkey", "province", refresh.region_of("province").alias("region"))
    return r.withColumn("temperature", refresh.temperature_text("region"))


# --- corpus -----------------------------------------------------------------------

def q_clean_text(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    c = corpus.clean_addresses(docs, "text", "cleaned")
    return c.select("doc_id", F.length("cleaned").alias("n_chars_clean"), F.md5("cleaned").alias("clean_md5"))


def q_address_features(spark, sf):
    c = corpus.clean_addresses(_customer_addresses(spark, sf))
    f = corpus.address_features(c)
    return f.select("c_custkey", "has_province", "has_city", "has_district", "has_street",
                    "address_length", "word_count")


def _rule_pairs(spark, sf):
    return corpus.qa_pairs_rule(corpus.clean_addresses(_customer_addresses(spark, sf)))


def q_qa_pairs_rule(spark, sf):
    return _rule_pairs(spark, sf)


def q_address_components(spark, sf):
    c = corpus.address_components(corpus.clean_addresses(_customer_addresses(spark, sf)))
    return c.select("c_custkey", F.col("c_province").alias("province"), F.col("c_city").alias("city"),
                    F.col("c_district").alias("district"), F.col("c_street").alias("street"),
                    F.col("c_detail").alias("detail"))


def q_qa_pairs_regex(spark, sf):
    return corpus.qa_pairs_regex(corpus.clean_addresses(_customer_addresses(spark, sf)))


def q_chat_text(spark, sf):
    return corpus.chat_turns(_t(spark, sf, "conversations"), "train").select("conv_id", "turn", "chat")


def q_chat_plain(spark, sf):
    return corpus.chat_turns(_t(spark, sf, "conversations"), "plain").select("conv_id", "turn", "chat")


def q_response_extract(spark, sf):
    turns = corpus.chat_turns(_t(spark, sf, "conversations"), "prompt")
    generated = turns.select("conv_id", "turn",
                             F.concat("chat", "output", F.lit(fixed.IM_END)).alias("generated"))
    return corpus.responses(generated, "generated").select("conv_id", "turn", "response")


def _encoded(spark, sf):
    return encode.encode_pairs(_rule_pairs(spark, sf), fixed.MAX_LENGTH, keep=("instruction", "output"))


def q_encode_tokens(spark, sf):
    e = _encoded(spark, sf)
    return e.select("instruction", "output",
                    F.array_join("input_ids", ",").alias("input_ids"),
                    "n_tokens", F.size("attention_mask").alias("mask_len"),
                    (F.col("labels") == F.col("input_ids")).alias("labels_match"))


def q_decode_tokens(spark, sf):
    d = encode.decode_ids(_encoded(spark, sf))
    return d.select("instruction", "output", "decoded")


def q_encode_conversations(spark, sf):
    """All ids of every rendered turn, whatever its length."""
    c = corpus.chat_turns(_t(spark, sf, "conversations"), "train")
    ids = c.select("conv_id", "turn", K.token_ids("chat").alias("ids"))
    return ids.select("conv_id", "turn", F.size("ids").alias("n_tokens"),
                      F.md5(F.array_join("ids", ",")).alias("ids_md5"))


def q_hash_split(spark, sf):
    return encode.train_eval_split(_t(spark, sf, "documents").select("doc_id"), "doc_id")


# --- reports ------------------------------------------------------------------------

def q_reconcile_tables(spark, sf):
    """Counts and key sums; the content sums are held against changed copies
    in ``reconcile_contents``."""
    return analytics.reconcile({n: (_t(spark, sf, n), k) for n, k in STORE_TABLES.items()}).drop("row_sum")


def q_reconcile_contents(spark, sf):
    """Orders against three copies: one value changed, equal but dealt out
    anew, one row missing."""
    o = _t(spark, sf, "orders")
    first = o.agg(F.min("o_orderkey")).scalar()
    price = F.when(F.col("o_orderkey") == first, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))
    copies = {"changed": o.withColumn("o_totalprice", price), "equal": o.repartition(7),
              "missing": o.where(F.col("o_orderkey") != first)}
    return analytics.compare_copies({n: (o, "o_orderkey") for n in copies},
                                    {n: (df, "o_orderkey") for n, df in copies.items()})


def q_basket_affinity(spark, sf):
    return analytics.basket_affinity(_t(spark, sf, "lineitem"))


def q_new_product_trend(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    return analytics.new_product_trend(li)


def q_report_rollup(spark, sf):
    return analytics.report_rollup(_t(spark, sf, "orders"), _t(spark, sf, "customer"),
                                   _t(spark, sf, "nation"), _t(spark, sf, "region"))


def q_dq_checks(spark, sf):
    return analytics.dq_checks(_t(spark, sf, "lineitem"), _t(spark, sf, "orders"),
                               _t(spark, sf, "part"), _t(spark, sf, "customer"))


# --- write, repeat, read back ---------------------------------------------------------

def q_sink_state_upsert(spark, sf):
    """Two batches into the committed state, the second one repeated."""
    ev = _t(spark, sf, "events").select(*KEYS, "event_id", "ts", "value")
    base, late = _scratch(spark, "state"), F.col("ts") >= _ts(STATE_CUTOFF)
    for part in (~late, late, late):
        writers.upsert_state(spark, ev.where(part), base, KEYS, ["ts", "event_id"])
    return writers.read_state(spark, base).select(*KEYS, "event_id", "value", T.time_text("ts").alias("ts"))


def q_sink_bucketed_state(spark, sf):
    """As ``sink_state_upsert``, rewriting only the buckets that a batch touches."""
    ev = _t(spark, sf, "events").select(*KEYS, "event_id", "ts", "value")
    path, late = _scratch(spark, "buckets"), F.col("ts") >= _ts(STATE_CUTOFF)
    for part in (~late, late, late):
        writers.upsert_partitioned_state(spark, ev.where(part), path, KEYS, ["ts", "event_id"], buckets=16)
    return spark.read.parquet(path).select(*KEYS, "event_id", "value", T.time_text("ts").alias("ts"))


def q_sink_kv_partitioned(spark, sf):
    """Orders by month and row key; then those of one day again with other
    prices, each key several times with the last put to count, twice: the
    other rows of the month stay."""
    o = _t(spark, sf, "orders")
    rows = o.select(T.time_text("o_orderdate", "yyyyMM").alias("partition_date"),
                    T.row_key(T.day_key("o_orderdate"), "o_orderkey").alias("rowkey"), "o_orderkey", "o_totalprice",
                    F.lit(0).alias("put"))
    path = _scratch(spark, "kv")
    writers.write_kv_partitioned(spark, rows, path, order_cols="put")
    again = (rows.where(F.col("rowkey").startswith(SCAN_DAY)).withColumn("put", F.explode(F.sequence(F.lit(1), F.lit(4))))
                 .withColumn("o_totalprice", F.when(F.col("put") == 4, 1.5).otherwise(10.0 * F.col("put"))))
    for _ in range(2):
        writers.write_kv_partitioned(spark, again, path, order_cols="put")
    return spark.read.parquet(path).select("rowkey", "o_orderkey", "o_totalprice")


def q_sink_cell_versions(spark, sf):
    """Versioned cells: early events, then late ones twice."""
    ev = _t(spark, sf, "events").select(T.row_key("user_id", "event_type").alias("rowkey"), "ts", "event_id", "value")
    path, late = _scratch(spark, "cells"), F.col("ts") >= _ts(STATE_CUTOFF)
    for part in (~late, late, late):
        writers.keep_cell_versions(spark, ev.where(part), path, "rowkey", "ts", tie_col="event_id", buckets=16)
    return spark.read.parquet(path).select("rowkey", "version", "event_id", "value")


def q_sink_day_bucketed(spark, sf):
    """Two batches into a table by batch and day, the second one repeated."""
    ev = _t(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("cdc_time"), "user_id",
                                        T.time_text("ts", fixed.DATE_TEXT_FORMAT).alias("ds"))
    name, path = f"events_{uuid.uuid4().hex}", _scratch(spark, "day-bucketed")
    late = F.col("cdc_time") >= _ts(STATE_CUTOFF)
    for batch, part in enumerate((~late, late)):
        for _ in range(batch + 1):
            writers.replace_batch(spark, ev.where(part).withColumn("batch_id", F.lit(batch).cast("bigint")), name, batch,
                                  path=path)
    rows = spark.read.schema(spark.table(name).schema).parquet(path)
    catalog.drop_table(spark, name)  # the files stay
    return rows.groupBy("ds").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


def q_corpus_round_trip(spark, sf):
    """Corpus records written as JSON and loaded by their extension."""
    c = corpus.chat_turns(_t(spark, sf, "conversations"), "prompt")
    path = _scratch(spark, "corpus") + ".json"
    writers.write_corpus(c.select(F.col("chat").alias("instruction"), "output",
                                  F.col("conv_id").cast("string").alias("original_address")), path)
    r = files.load_records(spark, path, "instruction string, input string, output string, original_address string")
    return r.select(F.col("original_address").cast("bigint").alias("conv_id"), F.md5("instruction").alias("prompt_md5"),
                    F.md5("output").alias("output_md5"), "input")


def q_state_round_trip(spark, sf):
    """The latest state as JSON, loaded back with its times parsed."""
    ev = _t(spark, sf, "events").select(*KEYS, "event_id", "ts")
    st = state.latest_per_key(ev, KEYS, ["ts", "event_id"]).withColumn("update_time", T.time_text("ts")).drop("ts")
    path = _scratch(spark, "state-json")
    st.write.json(path)
    loaded = files.load_state(spark, path, "user_id bigint, event_type string, event_id bigint, update_time string")
    return files.last_update_per_key(loaded, KEYS).withColumn("last_update", T.time_text("last_update"))


def q_delimited_table(spark, sf):
    """Customers as delimited text by nation, read as an external table."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.col("c_nationkey").alias("ds"))
    path = _scratch(spark, "csv")
    c.write.partitionBy("ds").option("header", True).csv(path)
    name = f"customers_{uuid.uuid4().hex}"
    catalog.create_delimited_table(spark, name, "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, ds INT", path, "ds")
    for n in _t(spark, sf, "nation").select("n_nationkey").collect():
        catalog.add_partition(spark, name, {"ds": n[0]})
    out = written(spark.sql(f"SELECT * FROM {name}"), "delimited")
    catalog.drop_table(spark, name)
    return out


def q_append_log(spark, sf):
    """Records appended twice to a log, and lines of blanks and tabs for
    every first turn; its lines that are not blank."""
    c = _t(spark, sf, "conversations").select("conv_id", "turn", "role")
    path = _scratch(spark, "log")
    for _ in range(2):
        writers.append_jsonl(c, path)
    blank = c.where("turn = 0").select(F.concat(F.lit(" \t"), F.repeat(F.lit("\t"), F.pmod("conv_id", F.lit(3)).cast("int"))).alias("value"))
    blank.write.mode("append").text(path)
    return refresh.non_blank_lines(spark, path)


def q_view_star(spark, sf):
    register_views(spark, sf, ["customer"])
    return spark.sql("SELECT * FROM customer")


def q_changelog_chain(spark, sf):
    """Two snapshots -> change rows -> flattened documents -> typed columns."""
    old, new = _snapshots(_t(spark, sf, "orders"))
    ch = changelog.diff_to_changelog(changelog.snapshot_diff(old, new, "o_orderkey"), "o_orderkey", "orders", AS_OF)
    flat = changelog.flatten(ch, cdc_time=_ts(AS_OF))
    doc = F.from_json("doc", "o_orderkey bigint, o_totalprice double, original_operation string, operation string, "
                             "old_data struct<o_orderkey: bigint, o_totalprice: double>")
    d = flat.select("change_id", doc.alias("d"))
    return d.select("change_id", F.coalesce("d.o_orderkey", "d.old_data.o_orderkey").alias("id"),
                    F.coalesce("d.original_operation", "d.operation").alias("operation"),
                    F.coalesce("d.o_totalprice", "d.old_data.o_totalprice").alias("price"))


def q_apply_changelog(spark, sf):
    """The current rows after all changes, applied in two parts; both are
    applied again, the earlier one last, which brings no removed row back."""
    ch = events_as_changelog(_t(spark, sf, "events"))
    late = F.col("change_time") >= _ts(STATE_CUTOFF)
    now = None
    for part in (~late, late, late, ~late):
        now = changelog.apply_changelog(now, ch.where(part), "k bigint")
    return changelog.current_rows(now).select("record_id", "change_id", "row.k")


QUERIES = {
    "sink_state_upsert": q_sink_state_upsert,
    "sink_bucketed_state": q_sink_bucketed_state,
    "sink_kv_partitioned": q_sink_kv_partitioned,
    "sink_cell_versions": q_sink_cell_versions,
    "sink_day_bucketed": q_sink_day_bucketed,
    "corpus_round_trip": q_corpus_round_trip,
    "state_round_trip": q_state_round_trip,
    "delimited_table": q_delimited_table,
    "append_log": q_append_log,
    "view_star": q_view_star,
    "changelog_chain": q_changelog_chain,
    "apply_changelog": q_apply_changelog,
    "status_counts": q_status_counts,
    "partition_scan": q_partition_scan,
    "rowkey_prefix_scan": q_rowkey_prefix_scan,
    "kv_mapped_view": q_kv_mapped_view,
    "kv_versions_top3": q_kv_versions_top3,
    "cursor_read": q_cursor_read,
    "cdc_flatten": q_cdc_flatten,
    "cdc_envelope": q_cdc_envelope,
    "snapshot_diff": q_snapshot_diff,
    "cdc_batch_metrics": q_cdc_batch_metrics,
    "lenient_load": q_lenient_load,
    "retention_window": q_retention_window,
    "multi_source_union": q_multi_source_union,
    "upsert_latest": q_upsert_latest,
    "upsert_accounting": q_upsert_accounting,
    "due_keys": q_due_keys,
    "cycle_counts": q_cycle_counts,
    "fallback_impute": q_fallback_impute,
    "change_projection": q_change_projection,
    "state_stats": q_state_stats,
    "success_rate": q_success_rate,
    "pair_expansion": q_pair_expansion,
    "nonblank_lines": q_nonblank_lines,
    "region_derive": q_region_derive,
    "clean_text": q_clean_text,
    "address_features": q_address_features,
    "qa_pairs_rule": q_qa_pairs_rule,
    "address_components": q_address_components,
    "qa_pairs_regex": q_qa_pairs_regex,
    "chat_text": q_chat_text,
    "chat_plain": q_chat_plain,
    "response_extract": q_response_extract,
    "encode_tokens": q_encode_tokens,
    "decode_tokens": q_decode_tokens,
    "encode_conversations": q_encode_conversations,
    "hash_split": q_hash_split,
    "reconcile_tables": q_reconcile_tables,
    "reconcile_contents": q_reconcile_contents,
    "basket_affinity": q_basket_affinity,
    "new_product_trend": q_new_product_trend,
    "report_rollup": q_report_rollup,
    "dq_checks": q_dq_checks,
    **UPKEEP,
}
