"""Structured Streaming: file-landed change rows, flatten, publish, load
per micro-batch, resume from the checkpoint."""

import json
import os

from pyspark.sql import functions as F

from tidemark.operators import changelog
from tidemark.streaming import cdc_stream


def _land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def _row(i, op, new=None, old=None):
    return {"change_id": i, "table_name": "users", "record_id": i % 5, "operation": op,
            "old_data": old, "new_data": new, "change_time": "2025-10-01 10:00:00"}


def test_flatten_stream_resumes(spark, tmp_dir):
    land, out, ck = (os.path.join(tmp_dir, x) for x in ("land", "out", "ck"))
    _land(land, "a.json", [_row(1, "I", json.dumps({"id": 1, "name": "a"})), _row(2, "D", old='{"id": 1}')])
    q = cdc_stream.publish(cdc_stream.flatten_stream(cdc_stream.changelog_stream(spark, land)),
                           "json", ck, out, available_now=True)
    q.awaitTermination()
    first = spark.read.json(out).count()
    obs = q.lastProgress["observedMetrics"]["changes"]
    assert obs["rows"] == 2 and obs["last_change_id"] == 2      # counters from the same pass
    _land(land, "b.json", [_row(3, "U", json.dumps({"id": 1, "name": "b"}), '{"id": 1}')])
    q = cdc_stream.publish(cdc_stream.flatten_stream(cdc_stream.changelog_stream(spark, land)),
                           "json", ck, out, available_now=True)
    q.awaitTermination()
    docs = [json.loads(r.value) for r in spark.read.json(out).collect()]
    assert first == 2 and len(docs) == 3
    by = {d.get("original_change_id", d.get("change_id")): d for d in docs}
    assert by[3]["name"] == "b" and by[2]["data_format"] == "original"
    # the batch form over the same rows gives the same documents (apart from cdc_time)
    batch = changelog.flatten(spark.read.schema(changelog.CHANGELOG_SCHEMA).json(land))
    bd = {json.loads(r.doc).get("original_change_id", json.loads(r.doc).get("change_id")): json.loads(r.doc)
          for r in batch.collect()}
    for k in bd:
        bd[k].pop("cdc_time")
        by[k].pop("cdc_time")
    assert bd == by


def test_load_batches_and_counters(spark, tmp_dir):
    land, metrics, ck = (os.path.join(tmp_dir, x) for x in ("land", "metrics", "ck"))
    _land(land, "a.json", [_row(i, "I", json.dumps({"id": i, "name": f"n{i}", "created_at": "2025-10-01 09:00:00"}))
                           for i in range(1, 6)])
    spark.sql("DROP TABLE IF EXISTS users_rt")
    flat = cdc_stream.flatten_stream(cdc_stream.changelog_stream(spark, land))
    schema = "id bigint, cdc_time string, name string, created_at string, source_db string"
    q = cdc_stream.load_batches(flat, "users_rt", metrics, ck, schema, available_now=True)
    q.awaitTermination()
    _land(land, "b.json", [_row(6, "I", json.dumps({"id": 6, "name": "n6"})), _row(7, "D", old='{"id": 2}'),
                           _row(8, "I", '{"id": 8, "name": ')])
    quarantine = os.path.join(tmp_dir, "quarantine")
    q = cdc_stream.load_batches(flat, "users_rt", metrics, ck, schema, available_now=True,
                                quarantine_path=quarantine)
    q.awaitTermination()
    assert [r.change_id for r in spark.read.json(quarantine).collect()] == [8]
    t = spark.table("users_rt")
    assert t.count() == 7 and t.where(F.col("id").isNull()).count() == 1  # delete passes through without id
    c = cdc_stream.batch_counters(spark, metrics).orderBy("batch_id").collect()
    assert [x.rows for x in c] == [5, 2] and c[-1].cumulative_rows == 7 and c[-1].last_change_id == 7


def test_maintain_latest(spark, tmp_dir):
    from tidemark.sinks import writers
    land, ck, base = (os.path.join(tmp_dir, x) for x in ("land", "ck", "state"))
    _land(land, "a.json", [{"k": 1, "v": "a", "seq": 1}, {"k": 2, "v": "b", "seq": 1}])
    src = spark.readStream.schema("k int, v string, seq int").json(land)
    cdc_stream.maintain_latest(src, base, ["k"], ["seq"], ck, available_now=True).awaitTermination()
    _land(land, "b.json", [{"k": 1, "v": "a2", "seq": 2}])
    cdc_stream.maintain_latest(src, base, ["k"], ["seq"], ck, available_now=True).awaitTermination()
    got = {(r.k, r.v) for r in writers.read_state(spark, base).collect()}
    assert got == {(1, "a2"), (2, "b")}


def test_refresh_stream_cycles(spark, tmp_dir):
    from tidemark.operators import refresh
    from tidemark.sinks import writers
    land, ck, base, changes, counts = (os.path.join(tmp_dir, x) for x in ("land", "ck", "state", "changes", "counts"))
    _land(land, "a.json", [{"base_currency": "USD", "target_currency": "EUR", "rate": 0.92}])
    snap = spark.readStream.schema(refresh.RATE_SNAPSHOT_SCHEMA).json(land)
    t1 = F.lit("2025-10-03 10:00:00").cast("timestamp_ntz")
    cdc_stream.refresh_stream(snap, base, changes, counts, ck, 3600, as_of=t1, available_now=True).awaitTermination()
    st = writers.read_state(spark, base)
    assert st.count() == 18 and st.where("is_fallback").count() == 17
    # second cycle, 30 minutes later: nothing is due
    t2 = F.lit("2025-10-03 10:30:00").cast("timestamp_ntz")
    _land(land, "b.json", [{"base_currency": "USD", "target_currency": "EUR", "rate": 0.95}])
    cdc_stream.refresh_stream(snap, base, changes, counts, ck, 3600, as_of=t2, available_now=True).awaitTermination()
    c = {r.batch_id: (r.n_due, r.n_skipped) for r in spark.read.json(counts).collect()}
    assert c == {0: (18, 0), 1: (0, 18)}
    assert spark.read.json(changes).count() == 18
    assert writers.read_state(spark, base).where("base_currency = 'USD' and target_currency = 'EUR'").first().rates == {"EUR": 0.92}


def test_maintain_latest_bucketed(spark, tmp_dir):
    land, ck, base = (os.path.join(tmp_dir, x) for x in ("land", "ck", "state"))
    _land(land, "a.json", [{"k": i, "v": f"a{i}", "seq": 1} for i in range(20)])
    src = spark.readStream.schema("k int, v string, seq int").json(land)
    cdc_stream.maintain_latest(src, base, ["k"], ["seq"], ck, available_now=True, buckets=4).awaitTermination()
    _land(land, "b.json", [{"k": 3, "v": "b3", "seq": 2}, {"k": 3, "v": "stale", "seq": 0}])
    cdc_stream.maintain_latest(src, base, ["k"], ["seq"], ck, available_now=True, buckets=4).awaitTermination()
    got = {r.k: r.v for r in spark.read.parquet(base).collect()}
    assert len(got) == 20 and got[3] == "b3" and got[4] == "a4"


def test_load_replay_replaces(spark, tmp_dir):
    """A batch that failed after its rows were written is loaded again: the
    rows replace themselves, and the counter says so."""
    from tidemark.sinks import writers
    land, metrics, ck = (os.path.join(tmp_dir, x) for x in ("land", "metrics", "ck"))
    _land(land, "a.json", [_row(i, "I", json.dumps({"id": i, "name": f"n{i}"})) for i in range(1, 4)])
    spark.sql("DROP TABLE IF EXISTS users_replay")
    flat = cdc_stream.flatten_stream(cdc_stream.changelog_stream(spark, land))
    schema = "id bigint, cdc_time string, name string, source_db string, origin string"
    load = lambda: cdc_stream.load_batches(
        flat, "users_replay", metrics, ck, schema, available_now=True, defaults={"origin": "cdc"}).awaitTermination()
    real, calls = writers.replace_batch, []

    def failing(*a, **k):
        real(*a, **k)
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("after the write")

    writers.replace_batch = failing
    try:
        try:
            load()
            raise AssertionError("expected the first attempt to fail")
        except Exception as e:  # noqa: BLE001
            assert "after the write" in str(e)
        load()
    finally:
        writers.replace_batch = real
    t = spark.table("users_replay")
    assert t.count() == 3 and {r.origin for r in t.collect()} == {"cdc"}
    assert [r.rows for r in cdc_stream.batch_counters(spark, metrics).collect()] == [3]
