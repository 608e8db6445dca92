"""A file sink outside Spark's own writers that holds every batch of a stream once.

Each task writes a file of its own; only when all tasks are done does the driver name these files in a commit file of the
stream and batch, which appears in one step.  Readers read what commit files name.  A batch that is delivered again finds
its commit file and writes nothing; files of failed tasks and given-up batches are named nowhere.

    <path>/data/<stream>/<batch>-<task>-<unique>.parquet
    <path>/commits/<stream>/<batch>.json

The path is reached through Arrow's file systems, from the driver and from every executor; it is one that all of them share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "committed"
#: Rows are written in row groups of about this many bytes.
GROUP_BYTES = 32 << 20


@dataclass(frozen=True)
class Place:
    """A sink folder and the names of what belongs to one stream in it."""

    path: str
    stream: str

    def __post_init__(self):
        if not self.stream or "/" in self.stream or self.stream.startswith("."):
            raise ValueError(f"not a stream name: {self.stream!r}")

    def system(self) -> tuple[arrow_fs.FileSystem, str]:
        system, base = arrow_fs.FileSystem.from_uri(self.path)
        return system, base.rstrip("/")

    def commit_file(self, batch: int) -> str:
        return f"commits/{self.stream}/{batch:012d}.json"

    def data_file(self, batch: int, task: int) -> str:
        return f"data/{self.stream}/{batch:012d}-{task:06d}-{uuid.uuid4().hex}.parquet"

    def is_committed(self, batch: int) -> bool:
        system, base = self.system()
        return system.get_file_info(f"{base}/{self.commit_file(batch)}").type == arrow_fs.FileType.File


def _listed(system: arrow_fs.FileSystem, folder: str) -> list[str]:
    chosen = arrow_fs.FileSelector(folder, allow_not_found=True, recursive=True)
    return sorted(f.path for f in system.get_file_info(chosen) if f.type == arrow_fs.FileType.File)


def committed_files(path: str, stream: str | None = None) -> list[tuple[str, int, str]]:
    """(stream, batch, file below the path) of everything that is committed, in order."""
    system, base = arrow_fs.FileSystem.from_uri(path)
    base, found = base.rstrip("/"), []
    for name in _listed(system, f"{base}/commits" + (f"/{stream}" if stream else "")):
        if not name.endswith(".json"):  # one that is being written
            continue
        with system.open_input_file(name) as file:
            commit = json.loads(file.read())
        found += [(commit["stream"], commit["batch"], data) for data in commit["files"]]
    return found


def sweep(path: str, stream: str) -> int:
    """Remove data files of a stream that no commit names: those of lost tasks.  Not while the stream runs."""
    place = Place(path, stream)
    system, base = place.system()
    named = {f"{base}/{name}" for _, _, name in committed_files(path, stream)}
    stray = [name for name in _listed(system, f"{base}/data/{stream}") if name not in named]
    for name in stray:
        system.delete_file(name)
    return len(stray)


@dataclass
class Written(WriterCommitMessage):
    """The files of a task."""

    files: list[str]


@dataclass(frozen=True)
class _Task:
    """What one task does: its batches to a file of its own, which goes if the task fails."""

    place: Place

    def write(self, batch: int, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        system, base = self.place.system()
        name = self.place.data_file(batch, TaskContext.get().partitionId())
        writer, held, size = None, [], 0
        try:
            for part in batches:
                if not part.num_rows:
                    continue
                if writer is None:
                    system.create_dir(f"{base}/data/{self.place.stream}")
                    writer = pq.ParquetWriter(f"{base}/{name}", part.schema, filesystem=system)
                held.append(part)
                size += part.nbytes
                if size >= GROUP_BYTES:
                    writer.write_table(pa.Table.from_batches(held))
                    held, size = [], 0
            if held:
                writer.write_table(pa.Table.from_batches(held))
        except BaseException:
            if writer is not None:
                writer.close()
                self.drop([name])
            raise
        if writer is None:
            return Written([])
        writer.close()
        return Written([name])

    def drop(self, names: list[str]) -> None:
        system, base = self.place.system()
        for name in names:
            if system.get_file_info(f"{base}/{name}").type == arrow_fs.FileType.File:
                system.delete_file(f"{base}/{name}")

    def commit(self, batch: int, messages: list[Written | None]) -> None:
        """Name the files of the batch.  If the batch is committed already, they are a repetition and go."""
        names = [name for message in messages if message for name in message.files]
        if self.place.is_committed(batch):
            self.drop(names)
            return
        system, base = self.place.system()
        target = f"{base}/{self.place.commit_file(batch)}"
        system.create_dir(target.rsplit("/", 1)[0])
        draft = f"{target}.{uuid.uuid4().hex}.draft"
        with system.open_output_stream(draft) as file:
            file.write(json.dumps({"stream": self.place.stream, "batch": batch, "files": names}).encode())
        system.move(draft, target)

    def abort(self, messages: list[Written | None]) -> None:
        self.drop([name for message in messages if message for name in message.files])


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, place: Place, batch: int):
        self.task, self.batch = _Task(place), batch
        self.done = place.is_committed(batch)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written([]) if self.done else self.task.write(self.batch, iterator)

    def commit(self, messages) -> None:
        if not self.done:
            self.task.commit(self.batch, messages)

    def abort(self, messages) -> None:
        self.task.abort(messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    """The number of the batch is known when it ends; files carry the number 0 until then, and their commit the right one."""

    def __init__(self, place: Place):
        self.task = _Task(place)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.task.write(0, iterator)

    def commit(self, messages, batchId: int) -> None:
        self.task.commit(batchId, messages)

    def abort(self, messages, batchId: int) -> None:
        self.task.abort(messages)


@dataclass
class _File(InputPartition):
    name: str


class _Reader(DataSourceReader):
    def __init__(self, path: str, stream: str | None, columns: list[str]):
        self.path, self.stream, self.columns = path, stream, columns

    def partitions(self) -> list[_File]:
        return [_File(name) for _, _, name in committed_files(self.path, self.stream)]

    def read(self, partition: _File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing is committed
            return
        system, base = arrow_fs.FileSystem.from_uri(self.path)
        with system.open_input_file(f"{base.rstrip('/')}/{partition.name}") as file:
            yield from pq.ParquetFile(file).iter_batches(columns=self.columns)


class Committed(DataSource):
    """Options: ``path``; ``stream``, a name for each checkpoint that writes; ``batch``, the number of a batch that a batch
    writer writes.  Reading wants a schema; without ``stream`` all streams are read."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _place(self) -> Place:
        return Place(self.options["path"], self.options.get("stream", ""))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("committed batches are not overwritten; use append")
        return _BatchWriter(self._place(), int(self.options["batch"]))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self._place())

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("stream"), schema.names)


def committed_sink(
    path: str, stream: str, shape: Callable[[DataFrame, int], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """A batch function for ``start`` and ``fan_out``: each (shaped) batch once, however often it is delivered."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.dataSource.register(Committed)
        rows = shape(batch, batch_id) if shape else batch
        writer = rows.write.format(FORMAT).mode("append").option("path", path)
        writer.option("stream", stream).option("batch", str(batch_id)).save()

    return write


def read_committed(spark: SparkSession, path: str, schema: StructType | str, stream: str | None = None) -> DataFrame:
    """All committed rows."""
    spark.dataSource.register(Committed)
    reader = spark.read.format(FORMAT).schema(schema).option("path", path)
    return (reader.option("stream", stream) if stream else reader).load()
