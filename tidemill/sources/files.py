"""File scans: CSV, ORC and two line formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.decode import Decoded
from tidemill.operators.evaluate import filter_computed


def read_csv(spark: SparkSession, base: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header, comma separated, UTF-8, blanks trimmed on both
    sides.  Types are inferred, which reads the data twice; give a schema to
    read large files once."""
    reader = spark.read.options(
        header=True,
        sep=",",
        encoding="utf-8",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(f"{base}/{table}")


def read_orc(spark: SparkSession, base: str, table: str, path: str | None = None) -> DataFrame:
    """ORC table below ``base/path``, by default below ``test_data``."""
    return spark.read.orc(f"{base}/{path or 'test_data'}/{table}")


def comma_records(lines: DataFrame, value: str = "value") -> Decoded:
    """``name,age,time`` lines; further fields are ignored.  Lines with fewer
    fields or an age that is no whole number are rejects."""
    parts = F.split(F.rtrim(F.col(value), F.lit(",")), ",", -1)
    age = F.get("_p", 1)
    fits = (F.size("_p") >= 3) & age.rlike(r"\A[+-]?[0-9]+\z") & age.try_cast("int").isNotNull()
    parsed = lines.withColumn("_p", parts).withColumn("_ok", F.coalesce(fits, F.lit(False)))
    good = filter_computed(parsed, F.col("_ok")).select(
        F.col("_p")[0].alias("name"),
        age.cast("int").alias("age"),
        F.col("_p")[2].alias("time"),
    )
    return Decoded(good, filter_computed(parsed, ~F.col("_ok")).select(*lines.columns))


def ampersand_posts(lines: DataFrame, value: str = "value") -> Decoded:
    """``"user"&"id"&epoch_ms&content`` lines; the content may hold further
    ampersands.  Lines with fewer fields or without a time are rejects."""
    millis = F.get("_p", 2).try_cast("long")
    fits = (F.size("_p") == 4) & millis.isNotNull()
    parsed = lines.withColumn("_p", F.split(F.col(value), "&", 4)).withColumn(
        "_ok", F.coalesce(fits, F.lit(False))
    )

    def unquoted(i: int):
        return F.btrim(F.col("_p")[i], F.lit('"'))

    good = filter_computed(parsed, F.col("_ok")).select(
        unquoted(0).alias("post_user_name"),
        unquoted(1).alias("rowkey"),
        F.timestamp_millis(millis).alias("event_time"),
        F.col("_p")[3].alias("post_content"),
    )
    return Decoded(good, filter_computed(parsed, ~F.col("_ok")).select(*lines.columns))


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Text lines as a ``value`` column, batch or stream."""
    return (spark.readStream if streaming else spark.read).text(path)
