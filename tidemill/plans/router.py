"""Multi-topic router: JSON check, routing by topic, two kinds of sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions.jsons import is_json_object
from tidemill.operators.cells import record_cells
from tidemill.operators.evaluate import filter_computed
from tidemill.operators.messages import route, to_row_topics
from tidemill.streaming.logs import BatchLog
from tidemill.streaming.run import BatchFunction, fan_out, log_sink, start

CELL_ROUTE = "cells"
MAIN_ROUTE = "main"


def route_messages(messages: DataFrame, cell_topics: list[str]) -> DataFrame:
    """JSON-object messages with a ``route``."""
    checked = filter_computed(messages, is_json_object("value"))
    return route(checked, {CELL_ROUTE: cell_topics}, MAIN_ROUTE)


def routed_cells(batch: DataFrame, batch_id: int, tables: dict[str, str]) -> DataFrame:
    """The cells of a routed batch."""
    routed = batch.filter(F.col("route") == CELL_ROUTE)
    return record_cells(routed, tables, version=batch_id, order=F.struct("partition", "offset"))


def republished(batch: DataFrame, batch_id: int) -> DataFrame:
    """The messages of a routed batch that go to topics of their own, as
    ``topic, key, value`` for a writer sink."""
    return to_row_topics(batch.filter(F.col("route") == MAIN_ROUTE))


def start_router(
    messages: DataFrame,
    tables: dict[str, str],
    base: str,
    checkpoint: str,
    once: bool = False,
    sinks: Sequence[BatchFunction] | None = None,
) -> StreamingQuery:
    """``tables`` maps each cell topic to its table.  The staged batch is
    partitioned by route, so each sink only reads its own files.

    ``sinks`` take the place of the two logs ``cells`` and ``published`` below
    ``base``; each gets the routed batch.  To publish to topics:
    ``writer_sink("kafka", republished, **{"kafka.bootstrap.servers": ...})``.
    """
    stage = BatchLog(f"{base}/routed", ("route",))

    def transform(batch: DataFrame, batch_id: int) -> DataFrame:
        return route_messages(batch, list(tables))

    if sinks is None:
        sinks = [
            log_sink(BatchLog(f"{base}/cells"), lambda batch, n: routed_cells(batch, n, tables)),
            log_sink(BatchLog(f"{base}/published"), republished),
        ]
    return start(messages, fan_out(stage, list(sinks), transform), checkpoint, once=once)
