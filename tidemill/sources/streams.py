"""Message streams."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemill import schemas
from tidemill.operators.decode import decode_envelope


@dataclass(frozen=True)
class Start:
    """Where a stream begins when its checkpoint directory is new.  With an
    existing checkpoint every stream resumes behind its last committed batch,
    whatever the start says."""

    options: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def earliest() -> Start:
        return Start({"startingOffsets": "earliest"})

    @staticmethod
    def latest() -> Start:
        return Start({"startingOffsets": "latest"})

    @staticmethod
    def timestamp(epoch_ms: int) -> Start:
        """At or after a time; a partition without such a record starts at its end."""
        return Start({"startingTimestamp": str(epoch_ms), "startingOffsetsByTimestampStrategy": "latest"})

    @staticmethod
    def offsets(positions: dict[str, dict[int, int]]) -> Start:
        """Offset per topic and partition (-2 earliest, -1 latest)."""
        text = {t: {str(p): o for p, o in parts.items()} for t, parts in positions.items()}
        return Start({"startingOffsets": json.dumps(text, sort_keys=True)})


def kafka_options(servers: str, topics: list[str], start: Start) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        **start.options,
    }


def kafka_messages(
    spark: SparkSession, servers: str, topics: list[str], start: Start, **options: str
) -> DataFrame:
    """One or several topics as ``topic, value, partition, offset, timestamp``
    with the value as text.  Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topics, start))
    return decode_envelope(reader.options(**options).load())


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.MESSAGE,
    file_format: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files of a directory as a stream, with an explicit schema."""
    reader = spark.readStream.schema(schema).format(file_format)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
