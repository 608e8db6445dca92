"""Tables that are updated by key and kept on files.

Rows lie in buckets by the hash of their key.  An update writes the buckets that it touches anew, into a folder of its own,
and then publishes a version: a small file that names the folder of every bucket.  Folders are never changed, so a reader
sees the version it began with, whole, while later ones are written.  A version also carries the last batch of each stream
that wrote it, which makes a batch that is delivered again do nothing.

    <path>/data/<version>-<unique>/rows/bucket=<b>/*.parquet
    <path>/versions/<version>.json
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.operators.documents import latest_by

# (current rows, delta with one row per key) -> the rows that take their place
Merge = Callable[[DataFrame, DataFrame], DataFrame]


class Conflict(RuntimeError):
    """Another writer has published the version first; the update can be run again."""


@dataclass(frozen=True)
class Version:
    number: int = -1
    folders: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


class Files:
    """The few driver-side steps on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.system = self.path(path).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(f.getPath().getName() for f in self.system.listStatus(at)) if self.system.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write a file that appears in one step; False if there is one of that name."""
        draft = self.path(f"{name}.{uuid.uuid4().hex}.draft")
        stream = self.system.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.system.exists(self.path(name)) or not self.system.rename(draft, self.path(name)):
            self.system.delete(draft, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def replace_rows(key: list[str]) -> Merge:
    """Whole rows by key (a document upsert)."""

    def merge(current: DataFrame, delta: DataFrame) -> DataFrame:
        return current.join(delta.select(*key), key, "left_anti").unionByName(delta)

    return merge


def supply_columns(key: list[str]) -> Merge:
    """Partial update: columns of the delta overwrite, NULL included; the others keep their value."""

    def merge(current: DataFrame, delta: DataFrame) -> DataFrame:
        supplied = [c for c in delta.columns if c not in key]
        changes = delta.select(*key, F.struct(*supplied).alias("_d"))
        given = F.col("_d").isNotNull()
        columns = [
            F.when(given, F.col("_d")[c]).otherwise(F.col(c)).alias(c) if c in supplied else F.col(c) for c in current.columns
        ]
        return current.join(changes, key, "full_outer").select(*columns)

    return merge


def newest_cells(key: list[str]) -> Merge:
    """Cells by row, family and qualifier: the greater version stays, the greater value of equal ones."""

    def merge(current: DataFrame, delta: DataFrame) -> DataFrame:
        rest = [c for c in current.columns if c not in key]
        order = ["version", *[c for c in rest if c != "version"]]
        newest = F.max(F.struct(*order)).alias("_n")
        both = current.unionByName(delta).groupBy(*key).agg(newest)
        return both.select(*[F.col(c) if c in key else F.col("_n")[c].alias(c) for c in current.columns])

    return merge


class KeyedTable:
    """A table with one row per key.

    ``buckets`` decides how much of the table an update of few keys writes again; it stays as it was when the table began.
    Keys are compared as Spark joins them: rows with a NULL in their key are refused.
    """

    def __init__(self, path: str, schema: StructType | str, key: list[str], buckets: int = 64):
        self.path, self.key, self.buckets = path.rstrip("/"), list(key), buckets
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    # -- versions

    def _versions(self, spark: SparkSession) -> list[int]:
        names = Files(spark, self.path).names(f"{self.path}/versions")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def version(self, spark: SparkSession, number: int | None = None) -> Version:
        """The newest version, or an earlier one."""
        there = self._versions(spark)
        if number is None and not there:
            return Version()
        wanted = there[-1] if number is None else number
        text = json.loads(Files(spark, self.path).read(f"{self.path}/versions/{wanted:012d}.json"))
        if text["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {text['buckets']} buckets, not {self.buckets}")
        return Version(wanted, text["folders"], text["batches"])

    def _publish(self, spark: SparkSession, version: Version) -> None:
        text = {"buckets": self.buckets, "folders": version.folders, "batches": version.batches}
        if not Files(spark, self.path).publish(f"{self.path}/versions/{version.number:012d}.json", json.dumps(text)):
            raise Conflict(f"version {version.number} of {self.path} exists")

    # -- reading

    def _rows(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """The rows of a version; later updates do not change the frame."""
        return self._rows(spark, sorted(set(self.version(spark, number).folders.values())))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _bucket_name(self) -> str:
        name = "bucket"
        while name in self.schema.names:
            name += "_"
        return name

    def get(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys; only their buckets are read."""
        spark, now = keys.sparkSession, self.version(keys.sparkSession)
        wanted = keys.select(*[F.col(c).cast(self.schema[c].dataType).alias(c) for c in self.key]).distinct()
        numbers = [str(r[0]) for r in wanted.select(self._bucket()).distinct().collect()]
        return self._rows(spark, [now.folders[b] for b in numbers if b in now.folders]).join(wanted, self.key, "left_semi")

    # -- writing

    def update(
        self, delta: DataFrame, merge: Merge, order: Column | None = None, whole: bool = True, stream: str = "", batch: int | None = None
    ) -> bool:
        """Merge a delta and publish the result; False if the stream's batch is in the table already.

        A ``whole`` delta gets the columns that it lacks, as NULL.
        ``order`` settles which of several delta rows of a key counts; without it the delta has one row per key.  The delta is
        written once before it is read several times.
        """
        spark, now = delta.sparkSession, self.version(delta.sparkSession)
        if batch is not None and batch <= now.batches.get(stream, -1):
            return False
        folder = f"data/{now.number + 1:012d}-{uuid.uuid4().hex}"
        one = latest_by(delta, self.key, order) if order is not None else delta
        one = one.select(*[F.col(f.name).cast(f.dataType) for f in self.schema if f.name in one.columns])
        missing = F.lit(False)
        for c in self.key:
            missing = missing | F.col(c).isNull()
        checked = F.when(missing, F.raise_error(F.lit("a key is NULL"))).otherwise(self._bucket())
        draft, name = f"{self.path}/{folder}/delta", self._bucket_name()
        one.withColumn(name, checked).write.partitionBy(name).parquet(draft)
        files = Files(spark, self.path)
        touched = sorted(n.removeprefix(f"{name}=") for n in files.names(draft) if n.startswith(f"{name}="))
        folders = dict(now.folders)
        if touched:
            fresh = spark.read.schema(one.schema).parquet(*[f"{draft}/{name}={b}" for b in touched])
            current = self._rows(spark, [now.folders[b] for b in touched if b in now.folders])
            merged = merge(current, self._with_all_columns(fresh) if whole else fresh)
            rows = merged.select(*self.schema.names).withColumn(name, self._bucket())
            # a bucket larger than a task should hold is written by several
            rows.hint("rebalance", name).write.partitionBy(name).parquet(f"{self.path}/{folder}/rows")
            folders |= {b: f"{folder}/rows/{name}={b}" for b in touched}
        files.delete(draft)
        batches = now.batches if batch is None else {**now.batches, stream: batch}
        self._publish(spark, Version(now.number + 1, folders, batches))
        return True

    def _with_all_columns(self, rows: DataFrame) -> DataFrame:
        given = set(rows.columns)
        return rows.select(*[F.col(f.name).cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema])

    def upsert(self, delta: DataFrame, order: Column | None = None, **batch) -> bool:
        return self.update(delta, replace_rows(self.key), order, **batch)

    def supply(self, delta: DataFrame, order: Column | None = None, **batch) -> bool:
        return self.update(delta, supply_columns(self.key), order, whole=False, **batch)

    def put_cells(self, delta: DataFrame, **batch) -> bool:
        """Cells, several versions of one cell allowed."""
        order = F.struct("version", *[c for c in delta.columns if c not in self.key and c != "version"])
        return self.update(delta, newest_cells(self.key), order, **batch)

    def sink(self, stream: str, write: Callable[..., bool], shape: Callable[[DataFrame, int], DataFrame] | None = None, **options):
        """A batch function that writes through ``upsert``, ``supply`` or ``put_cells``; ``stream`` names the checkpoint."""

        def process(rows: DataFrame, batch_id: int) -> None:
            write(shape(rows, batch_id) if shape else rows, stream=stream, batch=batch_id, **options)

        return process

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Remove all but the newest versions, and folders that none of these names: the number of removed folders.  Readers
        of older versions lose their files, and so does a writer that is under way."""
        files, there = Files(spark, self.path), self._versions(spark)
        kept = there[-max(keep, 1) :]
        named = {f.split("/")[1] for n in kept for f in self.version(spark, n).folders.values()}
        for number in there[: len(there) - len(kept)]:
            files.delete(f"{self.path}/versions/{number:012d}.json")
        stray = [n for n in files.names(f"{self.path}/data") if n not in named]
        for name in stray:
            files.delete(f"{self.path}/data/{name}")
        return len(stray)

