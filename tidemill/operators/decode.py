"""Message decoding with reject capture."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import schemas
from tidemill.functions.jsons import in_array, looks_like_object
from tidemill.operators.evaluate import filter_computed


@dataclass(frozen=True)
class Decoded:
    """Decoded rows and the untouched input rows that could not be decoded."""

    good: DataFrame
    rejects: DataFrame


def _parse(df: DataFrame, value: str, schema: T.StructType) -> DataFrame:
    """Add ``_r``: all fields as strings, NULL unless the text is one JSON
    object.  The array is a projection of its own, so it is parsed once."""
    loose = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    single = looks_like_object(value) & (F.size("_a") == 1)
    return (
        df.withColumn("_a", F.from_json(in_array(value), T.ArrayType(loose)))
        .withColumn("_r", F.when(single, F.get("_a", 0)))
        .drop("_a")
    )


def decode_json(
    df: DataFrame, schema: T.StructType, value: str = "value", fail_fast: bool = False
) -> Decoded:
    """Decode a JSON object column.  Missing fields are NULL and extra ones
    ignored; a text that is no JSON object, or a field that does not fit its
    type, is a reject.  With ``fail_fast`` the first reject fails the job."""
    fields = [F.col("_r")[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]
    parsed = _parse(df, value, schema)
    misfits = [
        F.col("_r")[f.name].isNotNull() & F.col("_r")[f.name].try_cast(f.dataType).isNull()
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    bad = F.col("_r").isNull()
    for misfit in misfits:
        bad = bad | misfit
    kept = [c for c in df.columns if c != value and c not in schema.names]
    if fail_fast:
        text = F.coalesce(F.col(value), F.lit("NULL"))
        failure = F.raise_error(F.concat(F.lit("malformed record: "), text))
        checked = parsed.withColumn("_r", F.when(bad, failure).otherwise(F.col("_r")))
        return Decoded(checked.select(*kept, *fields), df.limit(0))
    return Decoded(
        filter_computed(parsed, ~bad).select(*kept, *fields),
        filter_computed(parsed, bad).select(*df.columns),
    )


def decode_posts(df: DataFrame, value: str = "value") -> Decoded:
    """Post messages: malformed ones are skipped and exposed as rejects."""
    return decode_json(df, schemas.POST, value)


def decode_timed_records(df: DataFrame, value: str = "value", fail_fast: bool = False) -> Decoded:
    return decode_json(df, schemas.TIMED_RECORD, value, fail_fast)


def decode_envelope(df: DataFrame) -> DataFrame:
    """Raw message bytes to ``(topic, value)`` text, source position kept."""
    position = [c for c in ("partition", "offset", "timestamp") if c in df.columns]
    return df.select("topic", F.decode("value", "UTF-8").alias("value"), *position)


def encode_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each row as a JSON string ``value``; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))
