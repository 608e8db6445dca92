"""Late records of a stream by a running maximum that the engine keeps for each key.

The greatest event time of a key is its whole state, one number; no timer and no watermark is needed, and the checkpoint
carries it over restarts.  Against ``late.LateSplit``: one query and no state table of its own, but a key's records of one
micro-batch meet in one task.  Keys that hold most of a stream belong to ``LateSplit``, which splits them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidemill import fixed_values as fv

#: Below every event time; minus any delay it is still a whole number.
NEVER = -(1 << 62)


def flag_late_stream(
    stream: DataFrame,
    event_ms: str,
    keys: list[str],
    arrival: str | None = None,
    delay_ms: int = fv.OUT_OF_ORDERNESS_MS,
) -> DataFrame:
    """Add ``late`` to the records of a stream.

    With ``arrival``, a number that orders the records of a key, a record is late if its event time is at or behind the
    greatest one of all earlier records of its key, less the delay: what ``flag_late`` gives on all batches together.  The
    records of a key in one micro-batch are sorted, so a trigger bounds them.

    Without it the order inside a micro-batch is not known, and a record is compared with earlier micro-batches alone, as with
    a watermark that moves between batches.  Records then pass through in chunks, whatever their number.

    NULL is a key of its own.  A record without an event time is not late and moves nothing.  Whole numbers of 64 bits
    cross as text, since pandas would make floats of those beside a NULL; for arrays of them, with a NULL inside and beyond
    2^53, use ``LateSplit``.
    """
    if not keys:
        raise ValueError("a running maximum without a key is one task; use LateSplit")
    names = stream.columns
    # what the function calculates with stays a number
    crossing = {f.name for f in stream.schema if isinstance(f.dataType, LongType) and f.name not in (event_ms, arrival)}
    carried = stream.select(*[F.col(n).cast("string") if n in crossing else F.col(n) for n in names])
    schema = StructType([*carried.schema.fields, StructField("late", BooleanType())])

    def flagged(rows: pd.DataFrame, high: int) -> tuple[pd.DataFrame, int]:
        times = rows[event_ms]
        known = times.notna().to_numpy()
        numbers = times.where(known, NEVER).astype("int64").to_numpy()
        if arrival is None:
            before = np.full(len(rows), high)
        else:
            before = np.maximum.accumulate(np.concatenate([[high], numbers]))[:-1]
        late = known & (before > NEVER) & (numbers <= before - delay_ms)
        return rows[names].assign(late=late), max(high, int(numbers.max(initial=NEVER)))

    def process(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start = high = state.get[0] if state.exists else NEVER
        if arrival is not None:
            chunks = iter([pd.concat(list(chunks)).sort_values(arrival, kind="stable")])
        for rows in chunks:
            out, most = flagged(rows, start)
            high = max(high, most)
            yield out
        if high > NEVER:
            state.update((high,))

    flags = carried.groupBy(*keys).applyInPandasWithState(
        process, schema, "high_ms long", "append", GroupStateTimeout.NoTimeout
    )
    return flags.select(*[F.col(n).cast("long") if n in crossing else F.col(n) for n in names], "late")
