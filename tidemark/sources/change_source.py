"""Streaming source over a change table kept as Parquet: format ``changes``.

The table is a folder of files that jobs append to; ids grow, so a file that
arrives later holds greater ids than any change delivered before.  The offset
of the stream is the greatest ``change_id`` that it has delivered, kept in the
query's checkpoint: a restarted query goes on after the last batch that was
committed and repeats one that was not, with the same bounds.

A batch is planned from the statistics in the files' footers (read once a
file): row groups whose ids lie outside ``(start, end]`` are left out, the
others are dealt into partitions of about ``rowsperpartition`` rows and read
by the executors.

    register(spark)
    spark.readStream.format("changes").schema(CHANGELOG_SCHEMA).load(path)

Options: ``idcolumn`` (``change_id``), ``rowsperpartition`` (1,000,000),
``startafter`` (0: ids from 1 on; ids are not negative, pass -1 for 0).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "changes"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, for a local path or an address."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


@dataclass
class Piece:
    """Row groups of one file that may hold ids of the batch."""
    path: str
    groups: list[int]


@dataclass
class IdRange(InputPartition):
    after: int
    upto: int
    pieces: list[Piece]


class ChangeReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.path = options["path"]
        self.column = options.get("idcolumn", "change_id")
        self.rows = int(options.get("rowsperpartition", 1_000_000))
        self.start = int(options.get("startafter", 0))
        self.schema = schema
        self.known: dict[str, list[tuple[int, int, int]]] = {}  # file -> (least id, greatest id, rows) of each group

    def _files(self) -> dict[str, list[tuple[int, int, int]]]:
        store, root = file_system(self.path)
        listed = store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        for info in listed:
            name = info.path[len(root):].strip("/")
            hidden = any(part.startswith(("_", ".")) for part in name.split("/"))
            if info.type != pafs.FileType.File or hidden or not name.endswith(".parquet") or info.path in self.known:
                continue
            with store.open_input_file(info.path) as f:
                meta = pq.read_metadata(f)
            at = meta.schema.names.index(self.column)
            groups = []
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                if meta.row_group(g).num_rows and (stats is None or not stats.has_min_max):
                    raise ValueError(f"{info.path} has no statistics of {self.column}")
                groups.append((stats.min, stats.max, meta.row_group(g).num_rows) if stats and stats.has_min_max else (0, -1, 0))
            self.known[info.path] = groups
        return self.known

    def initialOffset(self) -> dict:
        return {"id": self.start}

    def latestOffset(self) -> dict:
        return {"id": max([self.start, *(high for groups in self._files().values() for _, high, _ in groups)])}

    def partitions(self, start: dict, end: dict) -> list[IdRange]:
        after, upto = start["id"], end["id"]
        out, size = [], 0
        for path, groups in sorted(self._files().items()):
            for number, (low, high, rows) in enumerate(groups):
                if high <= after or low > upto:
                    continue
                if not out or size + rows > self.rows:
                    out.append(IdRange(after, upto, []))
                    out[-1].value, size = len(out), 0
                pieces = out[-1].pieces
                if not pieces or pieces[-1].path != path:
                    pieces.append(Piece(path, []))
                pieces[-1].groups.append(number)
                size += rows
        return out

    def read(self, partition: IdRange) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        store, _ = file_system(self.path)
        schema = to_arrow_schema(self.schema)
        for piece in partition.pieces:
            with store.open_input_file(piece.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(row_groups=piece.groups, columns=schema.names):
                    ids = batch.column(self.column)
                    batch = batch.filter(pc.and_(pc.greater(ids, partition.after), pc.less_equal(ids, partition.upto)))
                    if len(batch):
                        yield pa.RecordBatch.from_arrays([batch.column(n).cast(schema.field(n).type) for n in schema.names],
                                                         schema=schema)


class ChangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> ChangeReader:
        return ChangeReader(schema, {k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ChangeSource)
