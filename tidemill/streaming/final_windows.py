"""Sliding windows of a stream that are told once, when they are complete, and whose state is freed then."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _window(time, size_ms: int, slide_ms: int, offset_ms: int):
    return F.window(time, f"{size_ms} milliseconds", f"{slide_ms} milliseconds", f"{offset_ms % slide_ms} milliseconds")


def final_windows(
    df: DataFrame, keys: list[str], value: str, size_ms: int, slide_ms: int,
    offset_ms: int = 0, event_time: str = "event_time",
) -> DataFrame:
    """``operators.events.sliding_aggregate`` over a stream with a watermark; run it in append mode.

    Rows are reduced to panes of one slide; a pane passes on when the watermark has reached its end, and is added to the
    windows that cover it, by its last moment.  So a row costs one update, where windows over rows cost ``size / slide``
    of them, and the state holds the panes and windows that can still change, whatever has passed before.

    A window is told when the watermark reaches its end.  Rows whose pane was told by an earlier batch are late and left out;
    ``windows.with_watermark`` takes the delay and the allowed lateness, and ``late`` or ``keyed_late`` keep late rows.
    Windows at the end of the input that the watermark has not reached are not told.
    """
    if size_ms % slide_ms:
        raise ValueError("the window size must be a multiple of the slide")
    panes = df.groupBy(_window(event_time, slide_ms, slide_ms, offset_ms).alias("_pane"), *keys).agg(
        F.count(value).alias("_n"),
        F.sum(value).alias("_sum"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    windows = panes.groupBy(_window(F.window_time("_pane"), size_ms, slide_ms, offset_ms).alias("_w"), *keys).agg(
        F.sum("_n").alias("n"),
        F.sum("_sum").alias("sum"),
        F.min("_min").alias("min"),
        F.max("_max").alias("max"),
    )
    return windows.select(
        *keys,
        F.unix_millis("_w.start").alias("window_start"),
        F.unix_millis("_w.end").alias("window_end"),
        "n",
        "sum",
        "min",
        "max",
        F.try_divide("sum", "n").alias("avg"),
    )
