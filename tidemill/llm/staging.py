"""Written tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemill.session import shared_dir


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back: it is computed once, and a lost executor costs no
    recomputation of what stands before it."""
    spark = frame.sparkSession
    path = shared_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shared_folder(spark, label: str) -> str:
    """A fresh folder below the shared one, as a URI or path."""
    return shared_dir(spark, label)
