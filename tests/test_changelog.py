"""Change-log operators."""

import json

from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.operators import changelog

def AS_OF():
    return F.lit("2025-10-01 12:00:00").cast("timestamp")


def _changes(spark):
    rows = [
        (1, "users", 10, "I", None, '{"id": 10, "name": "a", "source_db": "fake", "n": null, "tags": [1, {"x": 2}]}', "2025-10-01 10:00:00"),
        (2, "users", 10, "U", '{"id": 10, "name": "a"}', '{"id": 10, "name": "b"}', "2025-10-01 10:01:00"),
        (3, "users", 10, "D", '{"id": 10, "name": "b"}', None, "2025-10-01 10:02:00"),
        (4, "users", 11, "U", '{"id": 11}', "null", "2025-10-01 10:03:00"),
        (5, "users", 12, "U", '{"id": 12}', "", "2025-10-01 10:04:00"),
        (6, "users", 13, "U", '{"id": 13}', "[1, 2]", "2025-10-01 10:05:00"),
    ]
    return spark.createDataFrame(rows, "change_id long, table_name string, record_id int, operation string, "
                                       "old_data string, new_data string, change_time string") \
                .withColumn("change_time", F.col("change_time").cast("timestamp"))


def test_flatten_branches(spark):
    docs = {r.change_id: json.loads(r.doc) for r in changelog.flatten(_changes(spark), cdc_time=AS_OF()).collect()}
    ins = docs[1]
    assert ins["name"] == "a" and ins["n"] is None and ins["tags"] == [1, {"x": 2}]
    assert ins["source_db"] == fixed.SOURCE_DB  # metadata wins over the payload field
    assert ins["original_change_id"] == 1 and ins["original_operation"] == "I"
    assert ins["original_table_name"] == "users" and ins["cdc_time"] == "2025-10-01 12:00:00"
    assert "data_format" not in ins
    assert docs[2]["name"] == "b"
    for cid in (3, 4, 5, 6):
        d = docs[cid]
        assert d["data_format"] == "original" and d["change_id"] == cid and d["source_db"] == fixed.SOURCE_DB
        assert "original_change_id" not in d
    assert docs[3]["old_data"] == {"id": 10, "name": "b"} and "new_data" not in docs[3]
    assert "new_data" not in docs[5]          # empty text is dropped from the envelope
    assert docs[6]["new_data"] == [1, 2]


def test_envelope_omits_empty_images(spark):
    env = [json.loads(r.envelope) for r in changelog.with_envelope(_changes(spark)).orderBy("change_id").collect()]
    assert "old_data" not in env[0] and env[0]["new_data"]["name"] == "a"
    assert "new_data" not in env[2] and env[2]["operation"] == "D"


def test_cursor(spark):
    ch = _changes(spark)
    got = [r.change_id for r in changelog.after_cursor(ch, 3).collect()]
    assert got == [4, 5, 6]
    assert changelog.next_cursor(ch.where("change_id > 99"), previous=6).first().cursor == 6


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(2, "b2"), (3, None), (4, "d")], "id int, v string")
    d = {r.id: r.operation for r in changelog.snapshot_diff(old, new, "id").collect()}
    assert d == {1: "D", 2: "U", 4: "I"}


def test_running_total_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    vals = [(i, rnd.randint(0, 9)) for i in range(0, 500, 3)]
    df = spark.createDataFrame(vals, "k long, v long")
    got = {r.k: r.running_total for r in changelog.running_total(df, "k", "v", block_rows=25).collect()}
    acc, want = 0, {}
    for k, v in vals:
        acc += v
        want[k] = acc
    assert got == want


def test_batch_metrics(spark):
    df = spark.range(0, 2500).withColumnRenamed("id", "change_id")
    r = changelog.batch_metrics(df, batch_size=1000).orderBy("batch_no").collect()
    assert [(x.batch_no, x.batch_rows, x.last_id, x.cumulative_rows) for x in r] == [
        (0, 1000, 999, 1000), (1, 1000, 1999, 2000), (2, 500, 2499, 2500)]


def test_lenient_and_defaults(spark):
    df = spark.createDataFrame([("12", "2025-10-01 10:00:00", None), ("x", "bad", "mysql")],
                               "amount string, t string, source_db string")
    out = changelog.with_defaults(
        changelog.lenient_cast(df, {"amount": "bigint", "t": ("timestamp", fixed.TIME_TEXT_FORMAT)}),
        {"source_db": fixed.SOURCE_DB, "cdc_time": AS_OF()}).collect()
    assert out[0].amount == 12 and out[0].t is not None and out[0].source_db == "postgresql"
    assert out[1].amount is None and out[1].t is None and out[1].source_db == "mysql"
    assert out[0].cdc_time is not None


def test_retention_inclusive_days(spark):
    days = ["2025-09-23", "2025-09-24", "2025-10-01", "2025-10-04", "2025-10-05"]
    df = spark.createDataFrame([(d + " 23:59:59",) for d in days], "ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    kept = [r.ts.strftime("%Y-%m-%d") for r in changelog.retention_filter(df, "ts", AS_OF()).orderBy("ts").collect()]
    assert kept == ["2025-09-24", "2025-10-01", "2025-10-04"]


def test_merge_sources(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, 5.0)], "id int, score double")
    m = changelog.merge_sources({"postgresql": a, "sqlserver": b}).orderBy("id").collect()
    assert (m[0].source_db, m[0].score, m[1].source_db, m[1].name) == ("postgresql", None, "sqlserver", None)


def test_diff_to_changelog_round_trip(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    new = spark.createDataFrame([(2, "b2"), (3, "c"), (4, "d")], "id int, name string")
    d = changelog.snapshot_diff(old, new, "id")
    ch = changelog.diff_to_changelog(d, "id", "users", "2025-10-01 10:00:00", id_base=100)
    rows = {r.record_id: r for r in ch.collect()}
    assert {k: r.operation for k, r in rows.items()} == {1: "D", 2: "U", 4: "I"}
    assert rows[1].new_data is None and json.loads(rows[1].old_data) == {"id": 1, "name": "a"}
    assert rows[4].old_data is None and json.loads(rows[4].new_data) == {"id": 4, "name": "d"}
    ids = [r.change_id for r in rows.values()]
    assert sorted(ids) == [101, 102, 103]
    again = changelog.diff_to_changelog(d.repartition(5), "id", "users", "2025-10-01 10:00:00", id_base=100)
    assert {r.record_id: r.change_id for r in again.collect()} == {r.record_id: r.change_id for r in rows.values()}
    docs = {r.record_id: json.loads(r.doc) for r in changelog.flatten(ch, cdc_time=AS_OF()).collect()}
    assert docs[2]["name"] == "b2" and docs[2]["original_operation"] == "U"
    assert docs[1]["data_format"] == "original" and docs[1]["old_data"] == {"id": 1, "name": "a"}


def test_malformed_split(spark):
    rows = [(1, "users", 1, "I", None, '{"id": 1}', "2025-10-01 10:00:00"),
            (2, "users", 1, "U", '{"id": 1}', '{"id": 1, "name": ', "2025-10-01 10:01:00"),
            (3, "users", 1, "D", "not json", None, "2025-10-01 10:02:00"),
            (4, "users", 1, "U", '{"id": 1}', "", "2025-10-01 10:03:00")]
    df = spark.createDataFrame(rows, "change_id long, table_name string, record_id int, operation string, "
                                     "old_data string, new_data string, change_time string")
    assert sorted(r.change_id for r in changelog.malformed_changes(df).collect()) == [2, 3]
    assert sorted(r.change_id for r in changelog.well_formed_changes(df).collect()) == [1, 4]


def test_compared_columns_do_not_cut_the_images(spark):
    old = spark.createDataFrame([(3_000_000_000, "a", 1), (2, "b", 1)], "id long, name string, seen int")
    new = spark.createDataFrame([(3_000_000_000, "a2", 5), (2, "b", 9)], "id long, name string, seen int")
    d = changelog.snapshot_diff(old, new, "id", compare_cols=["name"])
    ch = changelog.diff_to_changelog(d, "id", "users", "2025-10-01 10:00:00").collect()
    assert [(r.change_id, r.record_id, r.operation) for r in ch] == [(1, 3_000_000_000, "U")]
    assert json.loads(ch[0].new_data) == {"id": 3_000_000_000, "name": "a2", "seen": 5}


def test_malformed_images_are_published_as_text(spark):
    df = spark.createDataFrame([(1, "users", 1, "U", '{"id": 1}', '{"a": broken', "2025-10-01 10:00:00")],
                               changelog.CHANGELOG_SCHEMA.replace("timestamp", "string"))
    doc = json.loads(changelog.flatten(df).first().doc)
    assert doc["data_format"] == "original" and doc["new_data_raw"] == '{"a": broken' and doc["old_data"] == {"id": 1}
    assert json.loads(changelog.with_envelope(df).first().envelope)["new_data_raw"] == '{"a": broken'


def test_batches_of_large_ids(spark):
    df = spark.createDataFrame([(9223372036854775000,), (9223372036854774999,), (5,)], "change_id long")
    got = [(r.batch_no, r.batch_rows, r.cumulative_rows) for r in changelog.batch_metrics(df).orderBy("batch_no").collect()]
    assert got == [(0, 1, 1), (9223372036854774, 1, 2), (9223372036854775, 1, 3)]


def test_apply_changelog(spark):
    rows = [(1, "u", 1, "I", None, '{"id": 1, "v": "a"}', None), (2, "u", 2, "I", None, '{"id": 2, "v": "b"}', None),
            (3, "u", 1, "U", '{"id": 1}', '{"id": 1, "v": "c"}', None), (4, "u", 2, "D", '{"id": 2}', None, None)]
    df = spark.createDataFrame(rows, changelog.CHANGELOG_SCHEMA)
    now = changelog.apply_changelog(None, df, "id long, v string")
    rows_of = lambda s: [(r.record_id, r.row.v) for r in changelog.current_rows(s).collect()]
    assert rows_of(now) == [(1, "c")]
    again = changelog.apply_changelog(now, df, "id long, v string")
    assert rows_of(again) == [(1, "c")]
    # an earlier part once more: what was removed stays removed
    assert rows_of(changelog.apply_changelog(again, df.where("change_id <= 2"), "id long, v string")) == [(1, "c")]
