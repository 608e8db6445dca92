"""Late records of a stream to their own output.

Spark drops late rows of an aggregation without telling, and one batch late.
Here every record is kept and flagged against the greatest event time of all
earlier records, batch boundaries included: the greatest times per key are
written beside each batch and read by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.operators.events import flag_late, high_event_times
from tidemill.streaming.logs import BatchLog
from tidemill.streaming.run import BatchFunction

LATE = "late"
ON_TIME = "on_time"


class LateSplit:
    """Records below ``base`` in two outputs, with the state between batches.

    Batch ``n`` reads the state of batch ``n - 1`` and writes its own, so a
    repeated batch computes the same result again.  ``arrival`` must grow from
    batch to batch (a message offset does).
    """

    def __init__(
        self,
        base: str,
        event_ms: str,
        arrival: str,
        keys: list[str] | None = None,
        delay_ms: int = fv.OUT_OF_ORDERNESS_MS,
        block_rows: int = 1_000_000,
        levels: int = 1,
    ):
        self.records = BatchLog(f"{base}/records", ("output",))
        self.high = BatchLog(f"{base}/high")
        self.logs = [self.records, self.high]
        self.event_ms, self.arrival, self.keys = event_ms, arrival, list(keys or [])
        self.delay_ms, self.block_rows, self.levels = delay_ms, block_rows, levels

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry = self.high.read_batch(spark, batch_id - 1) if batch_id else None
        flagged = flag_late(
            batch, self.event_ms, self.arrival, self.keys, self.delay_ms, self.block_rows, carry, self.levels
        )
        # both outputs in one pass, as partitions of one table
        output = F.when(F.col("late"), LATE).otherwise(ON_TIME)
        split = flagged.withColumn("output", output).drop("late")
        self.records.write(split, batch_id)

        written = self.records.read_batch(spark, batch_id, split.schema)
        times = high_event_times(written, self.event_ms, self.keys)
        if carry is not None:
            times = times.unionByName(carry).groupBy(*self.keys)
            times = times.agg(F.max("high_ms").alias("high_ms"))
        self.high.write(times, batch_id)

    __call__: BatchFunction = process

    def read(self, spark: SparkSession, output: str) -> DataFrame:
        """The records of one output; the other one's files are not read."""
        return self.records.read(spark).filter(F.col("output") == output).drop("output")
