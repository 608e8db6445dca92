"""Topic seeding: cell table to JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemill import fixed_values as fv
from tidemill.operators.cells import project_cells
from tidemill.operators.messages import to_topic


def seed_messages(cells: DataFrame, topic: str) -> DataFrame:
    """The newest state of every post row as one message each."""
    posts = project_cells(cells, [f for f in fv.POST_FIELDS if f != "rowkey"])
    return to_topic(posts.select(*fv.POST_FIELDS), topic)


def publish(messages: DataFrame, file_format: str = "kafka", **options: str) -> None:
    """Write messages with any batch writer; every row is sent."""
    messages.write.format(file_format).mode("append").options(**options).save()
