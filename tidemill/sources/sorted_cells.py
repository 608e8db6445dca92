"""Cells laid out by row key, so that gets and key ranges read few files.

A folder holds the cells, range-partitioned and sorted by row key, and the bounds of its files:

    <path>/cells/*.parquet    sorted by rowkey, family, qualifier, version, with a Bloom filter on the row key
    <path>/bounds/*.parquet   a row for each file: its name, first and last row key, number of cells

Both are written by Spark and a folder is written once; it is complete when its bounds are.  The bounds tell the files;
inside a file the row groups' and pages' statistics and the Bloom filter do the rest, as Spark's reader applies them to a
filter on the sorted column.
"""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.cells import CELL_KEY, rows_of
from tidemill.operators.evaluate import sized

SCHEMA = "rowkey string, family string, qualifier string, version long, value string"
BOUNDS = "file string, first string, last string, cells long"
SORT = [*CELL_KEY, "version"]
#: Keys that are given to the reader one by one, so that its Bloom filters can be asked: as many as it takes as equalities.
SINGLE_KEYS = 10


class SortedCells:
    """A cell table that is written whole and read by row key.

    Of cells with the same row, family, qualifier and version the greater value stays.  A cell without a row key is
    refused.  Row keys are compared as UTF-8 bytes.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    # -- writing

    def write(self, cells: DataFrame, files: int, keys_in_file: int = 100_000) -> None:
        """Write all cells into about ``files`` files and then their bounds; the folder must be new.

        Repeated cells shrink to one row per task before they are shuffled.  The ranges are cut by all four parts of a
        cell's address, so a row with very many cells lies in several files.  ``keys_in_file`` sizes the Bloom filters.
        """
        spark = cells.sparkSession
        key = F.when(F.col("rowkey").isNull(), F.raise_error(F.lit("a cell has no row key"))).otherwise(F.col("rowkey"))
        shaped = cells.select(key.cast("string").alias("rowkey"), "family", "qualifier", F.col("version").cast("long").alias("version"), "value")
        one = shaped.groupBy(*SORT).agg(F.max("value").alias("value"))
        options = {"parquet.bloom.filter.enabled#rowkey": "true", "parquet.bloom.filter.expected.ndv#rowkey": str(keys_in_file)}
        ranged = one.repartitionByRange(files, *SORT).sortWithinPartitions(*SORT)
        ranged.write.options(**options).parquet(f"{self.path}/cells")
        written = spark.read.schema(SCHEMA).parquet(f"{self.path}/cells")
        bounds = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min("rowkey").alias("first"), F.max("rowkey").alias("last"), F.count("*").alias("cells")
        )
        bounds.repartitionByRange("first").write.parquet(f"{self.path}/bounds")

    # -- reading

    def bounds(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(BOUNDS).parquet(f"{self.path}/bounds")

    def read(self, spark: SparkSession) -> DataFrame:
        """All cells."""
        return spark.read.schema(SCHEMA).parquet(f"{self.path}/cells")

    def _of(self, chosen: DataFrame) -> DataFrame:
        """The cells of the files that a frame of bounds names.  Only names reach the driver, which lists files anyway."""
        names = sorted(r.file for r in chosen.select("file").collect())
        if not names:
            return chosen.sparkSession.createDataFrame([], SCHEMA)
        return chosen.sparkSession.read.schema(SCHEMA).parquet(*[f"{self.path}/cells/{n}" for n in names])

    def scan(self, spark: SparkSession, first: str | None = None, stop: str | None = None) -> DataFrame:
        """Cells of the rows from ``first`` on and before ``stop``; None leaves a side open."""
        if first is None and stop is None:
            return self.read(spark)
        bounds, inside = self.bounds(spark), F.lit(True)
        if first is not None:
            bounds, inside = bounds.where(F.col("last") >= first), inside & (F.col("rowkey") >= first)
        if stop is not None:
            bounds, inside = bounds.where(F.col("first") < stop), inside & (F.col("rowkey") < stop)
        return self._of(bounds).where(inside)

    def near(self, keys: DataFrame) -> DataFrame:
        """The cells that may belong to some keys: a written frame ``rowkey`` of bounded size.

        The keys are sorted once and every file asks for the first key that is not before its own first one.
        """
        sorted_keys = sorted(r.rowkey for r in keys.where("rowkey IS NOT NULL").distinct().collect())
        if not sorted_keys:
            return keys.sparkSession.createDataFrame([], SCHEMA)

        @F.pandas_udf("boolean")
        def holds(first: pd.Series, last: pd.Series) -> pd.Series:
            places = [bisect_left(sorted_keys, f) for f in first]
            return pd.Series([k < len(sorted_keys) and sorted_keys[k] <= e for k, e in zip(places, last, strict=True)], dtype=bool)

        cells = self._of(self.bounds(keys.sparkSession).where(holds("first", "last")))
        if len(sorted_keys) <= SINGLE_KEYS:
            return cells.where(F.col("rowkey").isin(sorted_keys))
        return cells.where(F.col("rowkey").between(sorted_keys[0], sorted_keys[-1]))

    def get(self, keys: DataFrame, family: str | None = None) -> DataFrame:
        """Point get as ``operators.cells.get_rows`` does it.  Keys within the broadcast bounds read only the files that
        may hold them; more keys are joined with all cells by shuffle."""
        keys, few = sized(keys.select(F.col("rowkey").cast("string").alias("rowkey")))
        cells = self.near(keys) if few else self.read(keys.sparkSession)
        return rows_of(cells, keys, few, family)
