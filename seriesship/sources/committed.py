"""Committed folders: a source and sink of families, series and requests with a commit protocol.

    register(spark)
    series.write.format("metric_series").mode("append").save(path)
    spark.read.format("metric_series").load(path)
    spark.readStream.format("write_requests").load(path)
    requests.writeStream.format("write_requests").option("checkpointLocation", marks).start(path)

Every task writes one Parquet file of its own and reports it in a commit message. When all tasks are done, the driver
puts down one numbered commit that lists the files; only listed files are read, so a job shows as a whole or not at all,
and what killed, repeated or speculative tasks leave behind is never seen (a commit removes what its own job left). The
numbers of the commits are the offsets of a stream: each commit is read once, in order. A streaming write names its
micro-batch in the commit, so that a micro-batch written again after a crash changes nothing.

The folder is reached through Arrow's file systems, by a path or URI that the driver and all executors share. Where the
store can't create a file only if it is new (any but local ones), one driver at a time may commit to a folder.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as afs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from seriesship.schema import FAMILIES, REQUESTS, SERIES

COMMITS, FILES = "_commits", "files"
#: Bytes of files that one task reads, at least one file.
PART_BYTES = 16 << 20
ROWS_PER_GROUP = 1 << 16


@dataclass
class Written(WriterCommitMessage):
    """The file of one task; no name if it had no rows."""

    name: str
    rows: int
    bytes: int


@dataclass
class Files(InputPartition):
    names: list[str]


class Folder:
    """Commits and files of one path."""

    def __init__(self, path: str) -> None:
        local = path.removeprefix("file:")
        if "://" in path and not path.startswith("file:"):
            self.fs, self.root = afs.FileSystem.from_uri(path)
        else:
            self.fs, self.root = afs.LocalFileSystem(), "/" + local.lstrip("/") if local.startswith("/") else local

    def at(self, *names: str) -> str:
        return posixpath.join(self.root, *names)

    def exists(self) -> bool:
        return self.fs.get_file_info(self.root).type == afs.FileType.Directory

    def _names(self, *at: str) -> list[str]:
        found = self.fs.get_file_info(afs.FileSelector(self.at(*at), allow_not_found=True))
        return [f.base_name for f in found if f.type == afs.FileType.File]

    def numbers(self) -> list[int]:
        return sorted(int(n[:20]) for n in self._names(COMMITS) if n.endswith(".json") and n[:20].isdigit())

    def read_commit(self, number: int) -> dict:
        with self.fs.open_input_stream(self.at(COMMITS, f"{number:020d}.json")) as f:
            return json.loads(f.read())

    def files(self, after: int = -1, upto: int | None = None) -> list[tuple[str, int]]:
        """Listed files (name, bytes) of commits in (after, upto], from the last one on that replaces all before."""
        out: list[tuple[str, int]] = []
        for number in self.numbers():
            if number > after and (upto is None or number <= upto):
                commit = self.read_commit(number)
                out = ([] if commit["replaces"] else out) + [(f["name"], f["bytes"]) for f in commit["files"]]
        return out

    def _create(self, path: str, data: bytes) -> bool:
        """Writes a whole file if there is none of that name; readers never see a part of it."""
        draft = f"{path}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(data)
        if isinstance(self.fs, afs.LocalFileSystem):
            try:
                os.link(draft, path)
            except FileExistsError:
                return False
            finally:
                self.fs.delete_file(draft)
            return True
        if self.fs.get_file_info(path).type != afs.FileType.NotFound:
            self.fs.delete_file(draft)
            return False
        self.fs.move(draft, path)
        return True

    def commit(self, job: str, messages: list[Written | None], replaces: bool, batch: str | None = None) -> None:
        """Lists the files of a job in the next commit, unless its micro-batch has been committed before."""
        done = batch is not None and any(self.read_commit(n).get("batch") == batch for n in reversed(self.numbers()))
        written = [] if done else [m for m in messages if m is not None and m.name]
        if not done:
            listed = {"batch": batch, "replaces": replaces, "files": [vars(m) for m in written]}
            self.fs.create_dir(self.at(COMMITS), recursive=True)
            number = max(self.numbers(), default=-1) + 1
            while not self._create(self.at(COMMITS, f"{number:020d}.json"), json.dumps(listed).encode()):
                number += 1
        self.clean(job, {m.name for m in written})

    def clean(self, job: str, keep: set[str] = frozenset()) -> None:
        """Removes the files of a job that no commit lists."""
        for name in self._names(FILES, job):
            if f"{job}/{name}" not in keep:
                self.fs.delete_file(self.at(FILES, job, name))


class _Writer:
    def __init__(self, path: str, schema: StructType, replaces: bool, stream: str | None = None) -> None:
        self.path, self.schema, self.replaces, self.stream = path, schema, replaces, stream
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder, schema = Folder(self.path), to_arrow_schema(self.schema)
        name, rows, out = f"{self.job}/{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                folder.fs.create_dir(folder.at(FILES, self.job), recursive=True)
                out = pq.ParquetWriter(folder.at(FILES, name), schema, filesystem=folder.fs, compression="zstd")
            out.write_table(pa.Table.from_batches([batch]).cast(schema), row_group_size=ROWS_PER_GROUP)
            rows += batch.num_rows
        if out is None:
            return Written("", 0, 0)
        out.close()
        return Written(name, rows, folder.fs.get_file_info(folder.at(FILES, name)).size)


class BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list[Written | None]) -> None:
        Folder(self.path).commit(self.job, messages, self.replaces)

    def abort(self, messages: list[Written | None]) -> None:
        Folder(self.path).clean(self.job)


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    """``stream`` names the stream; its micro-batches count from 0."""

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        Folder(self.path).commit(self.job, messages, False, f"{self.stream}/{batchId}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        # Other micro-batches of this writer may stand under the same job.
        folder = Folder(self.path)
        listed = {name for name, _ in folder.files()}
        for m in messages:
            if m is not None and m.name and m.name not in listed:
                folder.fs.delete_file(folder.at(FILES, m.name))


def _parts(files: list[tuple[str, int]]) -> list[Files]:
    """Files in parts of about ``PART_BYTES``."""
    out: list[Files] = []
    held = PART_BYTES
    for name, size in files:
        if held + size > PART_BYTES:
            out.append(Files([]))
            held = 0
        out[-1].names.append(name)
        held += size
    return out


def _read(path: str, schema: StructType, part: Files) -> Iterator[pa.RecordBatch]:
    folder, wanted = Folder(path), to_arrow_schema(schema)
    for name in part.names:
        with pq.ParquetFile(folder.at(FILES, name), filesystem=folder.fs) as f:
            for batch in f.iter_batches(batch_size=1 << 13, columns=wanted.names):
                yield from pa.Table.from_batches([batch]).select(wanted.names).cast(wanted).to_batches()


class BatchReader(DataSourceReader):
    """Reads what is committed when the query is planned."""

    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.schema = path, schema

    def partitions(self) -> list[Files]:
        return _parts(Folder(self.path).files()) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _read(self.path, self.schema, partition)


class StreamReader(DataSourceStreamReader):
    """Offsets are numbers of commits."""

    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.schema = path, schema

    def initialOffset(self) -> dict:  # noqa: N802
        return {"commit": -1}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"commit": max(Folder(self.path).numbers(), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return _parts(Folder(self.path).files(start["commit"], end["commit"])) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _read(self.path, self.schema, partition)


class _Committed(DataSource):
    columns = ""

    def schema(self) -> str:
        return self.columns

    def _path(self, must_exist: bool) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError(f"{self.name()} needs a path")
        if must_exist and not Folder(path).exists():
            raise FileNotFoundError(path)
        return path

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(self._path(True), schema)

    def streamReader(self, schema: StructType) -> StreamReader:  # noqa: N802
        return StreamReader(self._path(True), schema)

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(self._path(False), self._checked(schema), overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:  # noqa: N802
        """Option ``writer`` names the stream; each stream into a folder needs a name of its own."""
        return StreamWriter(self._path(False), self._checked(schema), overwrite, self.options.get("writer", "main"))

    def _checked(self, schema: StructType) -> StructType:
        # There is no session here to parse a schema with.
        given = [f"{f.name} {f.dataType.simpleString()}" for f in schema]
        if sorted(given) != sorted(self.columns.split(", ")):
            raise ValueError(f"{self.name()} takes the columns {self.columns}, not {', '.join(given)}")
        return schema


class FamilySource(_Committed):
    columns = FAMILIES

    @classmethod
    def name(cls) -> str:
        return "metric_families"


class SeriesSource(_Committed):
    columns = SERIES

    @classmethod
    def name(cls) -> str:
        return "metric_series"


class RequestSource(_Committed):
    columns = REQUESTS

    @classmethod
    def name(cls) -> str:
        return "write_requests"


def register(spark: SparkSession) -> None:
    """Makes the formats ``metric_families``, ``metric_series`` and ``write_requests`` known to a session."""
    for source in (FamilySource, SeriesSource, RequestSource):
        spark.dataSource.register(source)
