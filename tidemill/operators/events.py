"""Event time, late records and sliding windows on bounded frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill import fixed_values as fv


def event_time_from_seconds(c: str) -> Column:
    return F.timestamp_seconds(F.col(c))


def event_time_from_millis(c: str) -> Column:
    return F.timestamp_millis(F.col(c))


def epoch_millis(c: str) -> Column:
    """Milliseconds since the epoch, also for timestamps without time zone."""
    return F.unix_millis(F.col(c).cast("timestamp"))


#: Blocks whose maxima are scanned together.
SPAN = 1000


def _earlier_maxima(blocks: DataFrame, keys: list[str], width: int, levels: int) -> DataFrame:
    """``_block, keys, _before``: the greatest ``_max`` of all earlier blocks of
    the key, from ``_block, keys, _max``; blocks begin at multiples of ``width``.

    Blocks are compared inside their span, and spans with each other the same way.
    """
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    if not levels:
        scan = earlier.partitionBy(*keys)
        return blocks.select("_block", *keys, F.max("_max").over(scan).alias("_before"))
    wide = width * SPAN
    spans = blocks.withColumn("_span", F.col("_block") - F.pmod(F.col("_block"), F.lit(wide)))
    summed = spans.groupBy(F.col("_span").alias("_block"), *keys).agg(F.max("_max").alias("_max"))
    outer = _earlier_maxima(summed, keys, wide, levels - 1).select(
        F.col("_block").alias("_span"), *keys, F.col("_before").alias("_outer")
    )
    inner = spans.withColumn("_inner", F.max("_max").over(earlier.partitionBy("_span", *keys)))
    return inner.join(outer, ["_span", *keys], "left").select(
        "_block", *keys, F.greatest("_inner", "_outer").alias("_before")
    )


def flag_late(
    df: DataFrame,
    event_ms: str,
    arrival: str,
    keys: list[str] | None = None,
    delay_ms: int = fv.OUT_OF_ORDERNESS_MS,
    block_rows: int = 1_000_000,
    carry: DataFrame | None = None,
    levels: int = 1,
) -> DataFrame:
    """Add ``late``: the event time is at or behind the greatest one seen
    earlier on the same key, less the delay.

    ``arrival`` is a whole number that orders the records of a key without
    ties (a message offset).  The running maximum is taken in two levels, so
    that one key holding most of the records is still spread over many tasks:
    each block of arrival numbers is summarised by its maximum, the maxima are
    scanned level by level, and records are only compared inside their own
    block, of at most ``block_rows`` records.  Sparse arrival numbers may give
    as many blocks as records: no task scans more than ``SPAN`` of a key, but
    for the last level, of one row for ``block_rows * SPAN ** levels`` numbers.
    Arrival numbers that are times in nanoseconds want two levels.  ``carry`` holds the greatest event time per key (``keys``,
    ``high_ms``) of earlier input, as returned by :func:`high_event_times`.
    """
    keys = list(keys or [])
    # NULL is a key of its own: as an empty text and a flag it can be joined
    joinable = {
        **{f"_k{i}": F.coalesce(F.col(k).cast("string"), F.lit("")) for i, k in enumerate(keys)},
        **{f"_n{i}": F.col(k).isNull() for i, k in enumerate(keys)},
    } or {"_k0": F.lit("")}
    by_key, by_block = [*joinable], ["_block", *joinable]
    block = F.col(arrival) - F.pmod(F.col(arrival), F.lit(block_rows))
    rows = df.withColumns({"_block": block, **joinable})

    blocks = rows.groupBy(*by_block).agg(F.max(event_ms).alias("_max"))
    before = _earlier_maxima(blocks, by_key, block_rows, levels)
    if carry is not None:
        carried = carry.withColumns(joinable).select(*by_key, F.col("high_ms").alias("_carry"))
        before = before.join(carried, by_key, "left").select(
            *by_block, F.greatest("_before", "_carry").alias("_before")
        )

    # the maximum of the earlier blocks enters its block as a first record,
    # which saves joining it to the records
    first = before.filter(F.col("_before").isNotNull()).withColumn("_first", F.lit(True))
    records = rows.withColumn("_first", F.lit(False)).unionByName(
        first.withColumnRenamed("_before", event_ms), allowMissingColumns=True
    )
    earlier_rows = (
        Window.partitionBy(*by_block)
        .orderBy(F.col("_first").desc(), arrival)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    late = F.col(event_ms) <= F.max(event_ms).over(earlier_rows) - delay_ms
    return (
        records.withColumn("late", F.coalesce(late, F.lit(False)))
        .filter(~F.col("_first"))
        .select(*df.columns, "late")
    )


def high_event_times(df: DataFrame, event_ms: str, keys: list[str] | None = None) -> DataFrame:
    """Greatest event time per key, ``(keys, high_ms)``."""
    return df.groupBy(*(keys or [])).agg(F.max(event_ms).alias("high_ms"))


def sliding_aggregate(
    df: DataFrame,
    time: str,
    keys: list[str],
    value: str,
    size_ms: int,
    slide_ms: int,
    offset_ms: int = 0,
) -> DataFrame:
    """Count, sum, min, max and average per key over sliding windows.

    Rows are first reduced to panes of one slide (map-side, one row per key and
    slide), and only the panes are copied into the windows that cover them.
    Copying the rows themselves would multiply the input by size / slide.
    ``window_start`` and ``window_end`` are epoch milliseconds.
    """
    if size_ms % slide_ms:
        raise ValueError("the window size must be a multiple of the slide")
    shift = offset_ms % slide_ms
    ms = epoch_millis(time)
    pane = ms - F.pmod(ms - shift, F.lit(slide_ms))
    panes = df.groupBy(*keys, pane.alias("_pane")).agg(
        F.count(value).alias("_n"),
        F.sum(value).alias("_sum"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    starts = F.sequence(
        F.col("_pane") - (size_ms - slide_ms), F.col("_pane"), F.lit(slide_ms).cast("long")
    )
    return (
        panes.withColumn("window_start", F.explode(starts))
        .groupBy(*keys, "window_start")
        .agg(
            F.sum("_n").alias("n"),
            F.sum("_sum").alias("sum"),
            F.min("_min").alias("min"),
            F.max("_max").alias("max"),
        )
        .select(
            *keys,
            "window_start",
            (F.col("window_start") + size_ms).alias("window_end"),
            "n",
            "sum",
            "min",
            "max",
            F.try_divide("sum", "n").alias("avg"),
        )
    )


def sliding_minute(df: DataFrame, time: str, keys: list[str], value: str) -> DataFrame:
    """One minute every ten seconds, windows shifted by eight hours."""
    return sliding_aggregate(df, time, keys, value, 60_000, 10_000, -8 * 3_600_000)


def sliding_hour(df: DataFrame, time: str, keys: list[str], value: str) -> DataFrame:
    """One hour every five minutes."""
    return sliding_aggregate(df, time, keys, value, 3_600_000, 300_000)
