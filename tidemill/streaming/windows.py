"""Watermarks and windowed aggregation on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill import fixed_values as fv


def with_event_time(df: DataFrame, source: str, unit: str, name: str = "event_time") -> DataFrame:
    """Event time from epoch ``seconds``, epoch ``millis`` or a ``timestamp``
    (also without time zone, which a watermark does not accept)."""
    column = F.col(source)
    event_time = {
        "seconds": lambda: F.timestamp_seconds(column),
        "millis": lambda: F.timestamp_millis(column),
        "timestamp": lambda: column.cast("timestamp"),
    }[unit]()
    return df.withColumn(name, event_time)


def with_watermark(
    df: DataFrame, event_time: str = "event_time", lateness_ms: int = 0,
    delay_ms: int = fv.OUT_OF_ORDERNESS_MS,
) -> DataFrame:
    """Watermark behind the greatest event time.  Allowed lateness has no knob
    of its own: it extends the delay, and the update output mode emits the
    refined windows."""
    return df.withWatermark(event_time, f"{delay_ms + lateness_ms} milliseconds")


def sliding_stream(
    df: DataFrame, keys: list[str], value: str, size_ms: int, slide_ms: int,
    offset_ms: int = 0, event_time: str = "event_time",
) -> DataFrame:
    """The streaming form of ``operators.events.sliding_aggregate``; run it in
    update mode.  Spark wants the offset below the slide, hence the modulo."""
    window = F.window(
        event_time,
        f"{size_ms} milliseconds",
        f"{slide_ms} milliseconds",
        f"{offset_ms % slide_ms} milliseconds",
    )
    return (
        df.groupBy(window.alias("_w"), *keys)
        .agg(
            F.count(value).alias("n"),
            F.sum(value).alias("sum"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
        .select(
            *keys,
            F.unix_millis("_w.start").alias("window_start"),
            F.unix_millis("_w.end").alias("window_end"),
            "n",
            "sum",
            "min",
            "max",
            F.try_divide("sum", "n").alias("avg"),
        )
    )
