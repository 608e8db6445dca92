"""Replay-safe output: one directory per micro-batch.

A micro-batch that is run again after a failure overwrites its own directory,
so every batch counts once.  Upserts are resolved when the log is read (newest
batch per key), which keeps the write an append of the new rows only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.operators.documents import latest_by


def refuse_stale(spark: SparkSession, checkpoint: str, logs: list[BatchLog]) -> None:
    """Raise if a new checkpoint would start over logs that have batches, of
    whatever number: its batch ids begin at 0 again and would overwrite theirs."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = lambda name: path(name).getFileSystem(spark._jsc.hadoopConfiguration())
    if system(checkpoint).exists(path(f"{checkpoint}/commits")):
        return
    for log in logs:
        if system(log.path).globStatus(path(f"{log.path}/batch_id=*")):
            raise ValueError(f"{log.path} holds batches of another checkpoint; choose a new folder")


@dataclass(frozen=True)
class BatchLog:
    path: str
    partition_by: tuple[str, ...] = ()

    def batch_path(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(self.batch_path(batch_id))

    def read_batch(self, spark: SparkSession, batch_id: int, schema: StructType | None = None) -> DataFrame:
        """One batch.  A log with partitions has no file for a batch without
        rows, so its reader gives the schema that was written."""
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(self.batch_path(batch_id))

    def read(self, spark: SparkSession) -> DataFrame:
        """All batches, with a ``batch_id`` column."""
        return spark.read.parquet(self.path)

    def latest(self, spark: SparkSession, key: list[str]) -> DataFrame:
        """The newest row per key."""
        return latest_by(self.read(spark), key, F.col("batch_id")).drop("batch_id")

    def compact(self, spark: SparkSession, key: list[str], target: BatchLog) -> None:
        """The newest rows as one batch of another log, to bound the number of
        directories a reader has to list.  Readers switch to the target."""
        last = self.read(spark).agg(F.max("batch_id")).first()[0]
        target.write(self.latest(spark, key), last)
