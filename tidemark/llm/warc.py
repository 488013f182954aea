"""WARC archives as a Spark data source (``format("warc")``).

*Writing.*  Every task writes gzip files with one member a record, rolled
at ``maxFileBytes``, under names of its own attempt; the driver commits
them by writing the list of files (``_files.json``) last, so files of lost
or repeated attempts are never read.

*Reading.*  The driver plans partitions from file sizes (the list, or for
foreign archives the ``*.warc`` and ``*.warc.gz`` files of a folder).  A
record's headers are parsed first; pushed predicates on the record type
and the other header columns drop it there, and the payload of a dropped
record, or any payload when no column asks for it, is passed over without
being decoded.  Files are the unit of reading, which the writer bounds.

Defined cases: a null payload counts as empty, a null url has no
``WARC-Target-URI``, a null id gets a random record id and reads back as
null; control characters of a url are percent-encoded.  Of rows with equal
payloads and ids, all that have the smallest id are responses; a null id
revisits any other, and where all are null all are responses.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import os
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, StringStartsWith, WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import materialise, small

SCHEMA = ("record_type string, record_id string, target_uri string, warc_date string, refers_to string, "
          "payload_digest string, payload_bytes long, headers map<string,string>, payload binary")
# header of each column that predicates can be pushed to
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
           "warc_date": "warc-date", "refers_to": "warc-refers-to"}
LENGTH = "X-Payload-Length"  # of the full payload, also in revisits
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LIST = "_files.json"
DATE = "2000-01-01T00:00:00Z"
WANTS_PAYLOAD = ("payload", "payload_bytes", "payload_digest")


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ----------------------------------------------------------------

def _clean(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 0x21 or ord(c) == 0x7F else c for c in value)


def record(kind: str, record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One record.  A revisit stores the HTTP head only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{_digest(payload)}", f"{LENGTH}: {len(payload)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class _Writer(DataSourceArrowWriter):
    """Columns ``record_type, record_id, target_uri, refers_to, payload``."""

    def __init__(self, options: dict, overwrite: bool = False):
        self.path, self.overwrite = options["path"], overwrite
        self.roll = int(options.get("maxfilebytes", 64 << 20))
        self.date = options.get("date", DATE)

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files, out, name, size = [], None, "", 0

        def close() -> None:
            if out is not None:
                out.close()
                files.append((name, size))

        for batch in batches:
            columns = [batch.column(c) for c in ("record_type", "record_id", "target_uri", "refers_to", "payload")]
            for row in zip(*columns):
                kind, rid, url, refers, payload = (x.as_py() for x in row)
                data = record(kind, rid or f"<urn:uuid:{uuid.uuid4()}>", url, payload or b"", refers, self.date)
                if out is None or size >= self.roll:
                    close()
                    name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(posixpath.join(root, name), compression=None)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = pack.compress(data) + pack.flush()
                out.write(member)
                size += len(member)
        close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        listed = posixpath.join(root, LIST)
        if not self.overwrite and store.get_file_info(listed).type == pafs.FileType.File:
            with store.open_input_stream(listed, compression=None) as f:
                files = [*map(tuple, json.loads(f.read())), *files]
        with store.open_output_stream(posixpath.join(root, LIST), compression=None) as out:
            out.write(json.dumps(files).encode())


    def abort(self, messages: list) -> None:
        """Remove what the finished tasks of a failed job wrote."""
        store, root = _store(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else ():
                store.delete_file(posixpath.join(root, name))


# --- reading ----------------------------------------------------------------

@dataclass
class _Part(InputPartition):
    files: list[str]


def _wanted(f: Filter) -> tuple[str, object] | None:
    """(header, test) of a predicate that headers can answer."""
    column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if column not in HEADERS:
        return None
    if isinstance(f, EqualTo):
        return HEADERS[column], ("in", (f.value,))
    if isinstance(f, In):
        return HEADERS[column], ("in", tuple(f.value))
    if isinstance(f, StringStartsWith):
        return HEADERS[column], ("starts", f.value)
    return None


def _passes(headers: dict[str, str], tests: list) -> bool:
    for header, (how, value) in tests:
        got = headers.get(header)
        if got is None or not (got in value if how == "in" else got.startswith(value)):
            return False
    return True


def _pass_over(stream, n: int) -> None:
    while n > 0:
        got = len(stream.read(min(n, 1 << 20)))
        if not got:
            raise EOFError("a record ends early")
        n -= got


def records(stream, tests: list, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers by lower-case name, block or None) of the records that pass."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue  # between records
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers, last = {}, None
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            if line[:1] in b" \t" and last:  # a folded line
                headers[last] += " " + line.decode("utf-8", "replace").strip()
                continue
            name, _, value = line.decode("utf-8", "replace").partition(":")
            last = name.strip().lower()
            headers[last] = value.strip()
        n = int(headers.get("content-length", 0))
        if not _passes(headers, tests):
            _pass_over(stream, n)
        elif payloads and headers.get("warc-type") != "revisit":
            block = stream.read(n)
            if len(block) < n:
                raise EOFError("a record ends early")
            yield headers, block
        else:
            _pass_over(stream, n)
            yield headers, None


class _Reader(DataSourceReader):
    BATCH = 8 << 20  # bytes of payload a batch

    def __init__(self, schema: StructType, options: dict):
        self.path, self.schema = options["path"], schema
        self.size = int(options.get("partitionbytes", 8 << 20))
        self.tests: list = []
        self.payloads = any(c in schema.fieldNames() for c in WANTS_PAYLOAD)

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            test = _wanted(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[_Part]:
        store, root = _store(self.path)
        listed = store.get_file_info(posixpath.join(root, LIST))
        if listed.type == pafs.FileType.File:
            with store.open_input_stream(listed.path, compression=None) as f:
                files = [(posixpath.join(root, n), s) for n, s in json.loads(f.read())]
        elif store.get_file_info(root).type == pafs.FileType.File:
            files = [(root, 0)]
        else:
            files = sorted((i.path, i.size) for i in store.get_file_info(pafs.FileSelector(root, recursive=True))
                           if i.path.endswith((".warc", ".warc.gz")))
        parts, room = [], 0
        for path, size in files:
            if not parts or size > room:
                parts.append(_Part([]))
                room = self.size
            parts[-1].files.append(path)
            room -= size
        return parts or [_Part([])]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        store, _ = _store(self.path)
        rows, held = [], 0
        for path in part.files:
            with store.open_input_stream(path, compression=None) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw)
                for headers, block in records(stream, self.tests, self.payloads):
                    rows.append(self._row(headers, block))
                    held += len(block or b"") + 500
                    if held > self.BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def _row(self, headers: dict[str, str], block: bytes | None) -> dict:
        row: dict = {c: headers.get(h) for c, h in HEADERS.items()}
        row["headers"] = list(headers.items())
        said = headers.get("warc-payload-digest", "").partition(":")[2] or None
        if block is None:
            length = headers.get(LENGTH.lower())
            return row | {"payload": None, "payload_digest": said,
                          "payload_bytes": int(length) if length is not None else None}
        payload = block
        if headers.get("content-type", "").startswith("application/http"):
            payload = block.partition(b"\r\n\r\n")[2]
        digest = _digest(payload)
        if said is not None and headers["warc-payload-digest"].startswith("sha1:") and said.upper() != digest:
            raise ValueError(f"{headers.get('warc-record-id')}: the payload isn't what its digest says")
        return row | {"payload": payload, "payload_digest": digest, "payload_bytes": len(payload)}


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self._lower())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self._lower(), overwrite)

    def _lower(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# --- pages ------------------------------------------------------------------

def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", least: int = 0) -> DataFrame:
    """The records of pages: of equal payloads of at least ``least`` bytes
    the one with the smallest id is the response, the others revisit it.

    Equal payloads are found by length and SHA-1, as the revisit profile
    defines; counting is combined before the shuffle, and only what occurs
    more than once is joined back (a hot payload's pages are split by the
    skew join)."""
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    p = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("target_uri"), payload.alias("payload"))
    p = p.withColumn("_sha", F.sha1("payload")).withColumn("_n", F.length("payload"))
    first = (p.where(F.col("_n") >= least).groupBy("_sha", "_n")
              .agg(F.count("*").alias("_c"), F.min("_id").alias("_first"))
              .where("_c > 1").select("_sha", "_n", "_first"))
    p = p.join(small(materialise(first, "warc-first")), ["_sha", "_n"], "left")
    again = F.coalesce(~F.col("_id").eqNullSafe(F.col("_first")) & F.col("_first").isNotNull(), F.lit(False))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    return p.select(F.when(again, "revisit").otherwise("response").alias("record_type"),
                    urn("_id").alias("record_id"), "target_uri",
                    F.when(again, urn("_first")).alias("refers_to"), "payload")


def write(records_: DataFrame, path: str, **options) -> None:
    """Write records as archives under ``path``, beside those that are there.
    One writer at a time: the list of files is replaced when a job commits."""
    register(records_.sparkSession)
    records_.write.format("warc").mode("append").options(**options).save(path)


def read(spark: SparkSession, path: str, schema: str | None = None, **options) -> DataFrame:
    """Records of archives; ``schema`` may name fewer columns."""
    register(spark)
    reader = spark.read.format("warc").options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def id_of(col: str, kind: str = "long"):
    """The page id in a record id that :func:`with_revisits` made."""
    return F.regexp_extract(F.col(col), r"^<urn:page:(.*)>$", 1).try_cast(kind)
