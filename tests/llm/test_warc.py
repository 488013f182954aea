import base64
import gzip
import hashlib
import os

import pyarrow as pa
import pytest

from tidemark.llm import warc
from tidemark.llm.common import shared_path

ROWS = [(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "u\r\nX: y", "é" * 5000), (None, "n", "x"),
        (5, "q", ""), (2, "http://b", "x"), (1, "http://c", "x"), (6, "n", "zz"), (7, "http://z", "<p>\r\n\r\nWARC/1.1\r\n")]


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame([(*r, "?") for r in ROWS], "page_id long, url string, html string, payload string")
    path = shared_path(spark, "warc-test")
    warc.write(warc.with_revisits(pages.repartition(3)), path, maxFileBytes=300)
    return path


def test_written_records_read_back(spark, archive):
    got = warc.read(spark, archive).select("*", warc.id_of("record_id").alias("page"),
                                           warc.id_of("refers_to").alias("first")).collect()
    first = {"x": 1, "": 3}
    want = []
    for i, url, html in ROWS:
        data = (html or "").encode()
        smallest = first.get(html or "", i)
        want.append((i, None if i == smallest else smallest, len(data),
                     base64.b32encode(hashlib.sha1(data).digest()).decode(), None if i != smallest else data))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.page, r.first, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload)
                    if r.payload != b"" else b"") for r in got), key=str) == sorted(want, key=str)
    assert {r.target_uri for r in got if r.page == 4} == {"u%0D%0AX:%20y"}


def test_header_predicates_are_pushed(spark, archive):
    q = warc.read(spark, archive).where("record_type = 'revisit' and target_uri like 'http://%'")
    assert {warc_row.record_id for warc_row in q.collect()} == {"<urn:page:2>"}
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "record_type" in plan.split("Filter")[1] and "= revisit" not in plan  # answered by the reader
    assert warc.read(spark, archive, "record_id string").where("record_id in ('<urn:page:4>', 'no')").count() == 1


def test_unwanted_payloads_are_not_decoded():
    data = warc.record("response", "<urn:page:1>", "u", b"abc", None, warc.DATE).replace(b"abc", b"abd")
    reader = warc._Reader(__import__("pyspark.sql.types", fromlist=["x"]).StructType().add("record_id", "string"),
                          {"path": "x"})
    import io
    found = list(warc.records(io.BytesIO(data), [], reader.payloads))
    assert found[0][1] is None  # a wrong payload passes unseen
    with pytest.raises(ValueError):
        headers, block = next(warc.records(io.BytesIO(data), [], True))
        reader._row(headers, block)


def test_foreign_archive(spark, tmp_dir):
    body = b"plain"
    text = (b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:1>\r\nX-Long: a\r\n b\r\n"
            b"Content-Length: 5\r\n\r\n" + body + b"\r\n\r\n") * 2
    with open(f"{tmp_dir}/a.warc", "wb") as f:
        f.write(text)
    with gzip.open(f"{tmp_dir}/b.warc.gz", "wb") as f:
        f.write(text)
    got = warc.read(spark, tmp_dir).collect()
    assert len(got) == 4 and all(bytes(r.payload) == body and r.headers["x-long"] == "a b" for r in got)


def test_empty_table(spark):
    path = shared_path(spark, "warc-test")
    warc.write(warc.with_revisits(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert warc.read(spark, path).count() == 0


def test_append_keeps_earlier_records(spark):
    path = shared_path(spark, "warc-append")
    for i in range(3):
        page = spark.createDataFrame([(i, f"http://{i}", f"page {i}")], "page_id long, url string, html string")
        warc.write(warc.with_revisits(page), path)
    assert sorted(r.p for r in warc.read(spark, path).select(warc.id_of("record_id").alias("p")).collect()) == [0, 1, 2]


def test_failed_job_leaves_no_files(spark):
    from pyspark.sql.types import StringType, StructField, StructType

    path = shared_path(spark, "warc-abort")
    names = ["record_type", "record_id", "target_uri", "refers_to", "payload"]
    schema = StructType([StructField(n, StringType()) for n in names])
    writer = warc.WarcSource({"path": path}).writer(schema, False)
    batch = pa.RecordBatch.from_arrays([pa.array([x]) for x in ("response", "<urn:page:1>", "u", None)] + [pa.array([b"x"])], names=names)
    done = writer.write(iter([batch]))
    assert len(os.listdir(path.removeprefix("file:"))) == 1
    writer.abort([done, None])
    assert os.listdir(path.removeprefix("file:")) == []


def test_text_ids(spark):
    pages = spark.createDataFrame([("a b", "u", "x"), ("c", "u", "x")], "page_id string, url string, html string")
    path = shared_path(spark, "warc-text")
    warc.write(warc.with_revisits(pages), path)
    got = {(r.p, r.f) for r in warc.read(spark, path).select(warc.id_of("record_id", "string").alias("p"),
                                                             warc.id_of("refers_to", "string").alias("f")).collect()}
    assert got == {("a b", None), ("c", "a b")}
