"""Which version of a dimension each batch of a stream read."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tidemill.streaming.keyed import Files, KeyedTable


class BoundSnapshot:
    """A dimension kept as a keyed table, one version bound to each batch.

    Before a batch runs, the version that is the newest then is written down under the number of the batch.  A batch that
    runs again, on this driver or a later one, reads that version, so it gives the rows it gave before although the table has
    changed.  ``every`` keeps a version for so many batches.  Versions that are bound must not be vacuumed away while
    their batch may run again.
    """

    def __init__(self, spark: SparkSession, table: KeyedTable, path: str, every: int = 1):
        if every < 1:
            raise ValueError("every must be 1 or more")
        self.spark, self.table, self.path, self.every = spark, table, path.rstrip("/"), every

    def version_of(self, batch_id: int) -> int:
        """The version bound to a batch, which is bound now if it was not."""
        files, first = Files(self.spark, self.path), batch_id - batch_id % self.every
        name = f"{first:012d}.json"
        if name not in files.names(self.path):
            now = json.dumps({"version": self.table.version(self.spark).number})
            files.publish(f"{self.path}/{name}", now)  # if another driver was first, its version holds
        return json.loads(files.read(f"{self.path}/{name}"))["version"]

    def at(self, batch_id: int) -> DataFrame:
        number = self.version_of(batch_id)
        if number < 0:  # the table had no version yet
            return self.spark.createDataFrame([], self.table.schema)
        return self.table.read(self.spark, number)
