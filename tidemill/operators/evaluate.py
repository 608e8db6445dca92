"""Placing expensive column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import shared_dir


def filter_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on columns that were computed in the projection below.

    The optimizer pushes a plain filter through the projection by copying the
    computed expression into it, so every surviving row pays for it twice (2.5
    times the run time for the cleaning chain).  A projection with a
    non-deterministic column (the task number, the cheapest one) keeps the
    filter above it; both still run in one generated stage.  Filters on stored
    columns belong in front of this step, where they reach the scan.
    """
    return (
        df.withColumn("_task", F.spark_partition_id())
        .filter(condition & (F.col("_task") >= 0))
        .drop("_task")
    )


def spread(df: DataFrame) -> DataFrame:
    """Spread a bounded frame of few scan tasks over all cores, for expressions
    that cost more than a shuffle of their input.  A file cannot be split below
    its row groups, so a small input may come as one task.  Inputs with at least
    one task per core, as large ones have, are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 8 << 20


def is_small(df: DataFrame) -> bool:
    """Whether a written frame stays below the broadcast bounds.  Rows are
    counted in the files' footers; only those of a frame with few rows are read,
    to sum up their bytes (as JSON, which is no shorter than the values)."""
    if df.count() > MAX_BROADCAST_ROWS:
        return False
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    return (df.agg(F.sum(size)).first()[0] or 0) <= MAX_BROADCAST_BYTES


def sized(df: DataFrame) -> tuple[DataFrame, bool]:
    """The frame as a written table, and whether it is small.  What is written
    is measured as it is, its lineage does not run again, and a model or a
    random value in it gives one answer for all uses."""
    if df.isStreaming:
        return df, False
    path = shared_dir(df.sparkSession, "sized")
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return written, is_small(written)
