"""Message envelopes, routing and start positions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import as_column
from tidemill.operators.evaluate import sized


def to_topic(df: DataFrame, topic: str, columns: list[str] | None = None) -> DataFrame:
    """Every row as a JSON message of one topic."""
    return df.select(
        F.lit(topic).alias("topic"), F.to_json(F.struct(*(columns or df.columns))).alias("value")
    )


def to_row_topics(df: DataFrame, topic: str = "topic", value: str = "value") -> DataFrame:
    """Messages with a topic per row, no key and UTF-8 bytes as value."""
    return df.select(
        F.col(topic).alias("topic"),
        F.lit(None).cast("binary").alias("key"),
        F.encode(F.col(value), "UTF-8").alias("value"),
    )


def to_hash(df: DataFrame, name: str, field: Column | str, value: Column | str) -> DataFrame:
    """Entries ``(hash, field, value)`` of a hash structure."""
    return df.select(
        F.lit(name).alias("hash"),
        as_column(field).cast("string").alias("field"),
        as_column(value).cast("string").alias("value"),
    )


def route(
    messages: DataFrame, rules: dict[str, list[str]], default: str = "main", topic: str = "topic"
) -> DataFrame:
    """Add the ``route`` of each message by its topic."""
    branches = F.lit(default)
    for name, topics in rules.items():
        branches = F.when(F.col(topic).isin(*topics), name).otherwise(branches)
    return messages.withColumn("route", branches)


def end_positions(messages: DataFrame) -> DataFrame:
    """Where a reader that starts at the latest message begins."""
    return messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("start_offset")
    )


def from_timestamp(messages: DataFrame, start: datetime | Column) -> DataFrame:
    """Messages at or after a time; pushed into the scan."""
    start = start if isinstance(start, Column) else F.lit(start)
    return messages.filter(F.col("timestamp") >= start)


def from_offsets(messages: DataFrame, positions: DataFrame) -> DataFrame:
    """Messages at or behind their partition's start offset; partitions
    without one are read from the beginning.  ``positions`` has one small row
    per partition and is broadcast unless it turns out large."""
    positions, few = sized(positions)
    starts = F.broadcast(positions) if few else positions
    return (
        messages.join(starts, ["topic", "partition"], "left")
        .filter(F.col("start_offset").isNull() | (F.col("offset") >= F.col("start_offset")))
        .drop("start_offset")
    )


def in_input_order(df: DataFrame) -> DataFrame:
    """Rows in source order.  A range-partitioned sort: a topic holding most
    of the messages is spread over many tasks."""
    return df.orderBy("topic", "partition", "offset")
