"""Event time, late records and sliding windows on bounded tables."""

from pyspark.sql import functions as F

from tidemill.operators import events as V
from tidemill.operators import messages as M
from tidemill.operators.evaluate import spread
from tidemill.queries import inputs
from tidemill.queries.registry import query, table

# values in whole cents: exact sums in any order
CENTS_SQL = "round(value * 100)::BIGINT"


def cents():
    return F.round(F.col("value") * 100).cast("long").alias("cents")


def events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", cents())


@query("event_time_seconds", "SELECT event_id, epoch_us(ts) // 1000000 * 1000 AS event_ms FROM events")
def event_time_seconds(spark, sf):
    seconds = table(spark, sf, "events").select(
        "event_id", F.floor(inputs.epoch_ms() / 1000).alias("timestamp")
    )
    times = seconds.select("event_id", V.event_time_from_seconds("timestamp").alias("event_time"))
    return times.select("event_id", F.unix_millis("event_time").alias("event_ms"))


@query("event_time_millis", "SELECT event_id, epoch_us(ts) // 1000 AS event_ms FROM events")
def event_time_millis(spark, sf):
    millis = table(spark, sf, "events").select("event_id", inputs.epoch_ms().alias("ms"))
    times = millis.select("event_id", V.event_time_from_millis("ms").alias("event_time"))
    return times.select("event_id", F.unix_millis("event_time").alias("event_ms"))


def windows_sql(size_ms: int, slide_ms: int) -> str:
    """Every row copied into each window that covers it."""
    return f"""SELECT event_type, s AS window_start, s + {size_ms} AS window_end, count(*) AS n,
sum(cents)::BIGINT AS sum, min(cents) AS min, max(cents) AS max, sum(cents)::DOUBLE / count(*) AS avg FROM (
SELECT event_type, {CENTS_SQL} AS cents,
unnest(range(epoch_us(ts) // 1000 // {slide_ms} * {slide_ms} - {size_ms - slide_ms},
epoch_us(ts) // 1000 // {slide_ms} * {slide_ms} + 1, {slide_ms})) AS s FROM events) GROUP BY ALL"""


MINUTE_SQL = windows_sql(60_000, 10_000)
HOUR_SQL = windows_sql(3_600_000, 300_000)


@query("sliding_minute", MINUTE_SQL)
def sliding_minute(spark, sf):
    return V.sliding_minute(events(spark, sf), "ts", ["event_type"], "cents")


@query("sliding_hour", HOUR_SQL)
def sliding_hour(spark, sf):
    return V.sliding_hour(events(spark, sf), "ts", ["event_type"], "cents")


# the events arrive in time order; some are set back by up to an hour
JITTER_SQL = "CASE WHEN event_id % 13 = 0 THEN 3600000 ELSE event_id * 7919 % 10001 END"
JITTERED_SQL = f"SELECT event_id, event_type, epoch_us(ts) // 1000 - {JITTER_SQL} AS event_ms FROM events"


def jittered(frame):
    shift = F.when(F.col("event_id") % 13 == 0, 3_600_000).otherwise(F.col("event_id") * 7919 % 10001)
    return frame.select(
        "event_id", "event_type", (inputs.epoch_ms() - shift).alias("event_ms")
    )


def late_sql(partition: str) -> str:
    return f"""SELECT *, coalesce(event_ms <= max(event_ms) OVER ({partition} ORDER BY event_id
ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 2500, false) AS late FROM ({JITTERED_SQL})"""


LATE_BY_TYPE_SQL = late_sql("PARTITION BY event_type")


@query("late_records", LATE_BY_TYPE_SQL)
def late_records(spark, sf):
    """One watermark per topic."""
    frame = jittered(table(spark, sf, "events"))
    return V.flag_late(frame, "event_ms", "event_id", ["event_type"], block_rows=1000)


@query("late_records_global", late_sql(""))
def late_records_global(spark, sf):
    """One watermark over the whole log, still computed in blocks."""
    frame = jittered(table(spark, sf, "events"))
    return V.flag_late(frame, "event_ms", "event_id", block_rows=1000)


SPARSE = 1_000_000_007


@query("late_records_sparse", late_sql("").replace("SELECT *,", f"SELECT event_id * {SPARSE} AS event_id, event_type, event_ms,"))
def late_records_sparse(spark, sf):
    """Arrival numbers far apart: every record is a block of its own."""
    frame = jittered(table(spark, sf, "events")).withColumn("event_id", F.col("event_id") * SPARSE)
    return V.flag_late(frame, "event_ms", "event_id", levels=2)


# -- start positions of a message log -------------------------------------------------

POSITION_SQL = 'topic, partition, "offset"'


def log(spark, sf):
    return inputs.messages(spread(table(spark, sf, "events")))


@query("start_earliest", f"SELECT {POSITION_SQL}, value FROM ({inputs.MESSAGES_SQL})")
def start_earliest(spark, sf):
    return log(spark, sf).select("topic", "partition", "offset", "value")


@query(
    "start_latest",
    f'SELECT topic, partition, max("offset") + 1 AS start_offset FROM ({inputs.MESSAGES_SQL}) GROUP BY ALL',
)
def start_latest(spark, sf):
    """Where each partition would be read from."""
    return M.end_positions(log(spark, sf))


START = "2024-01-10 12:00:00"


@query(
    "start_timestamp",
    f"SELECT {POSITION_SQL} FROM ({inputs.MESSAGES_SQL}) WHERE ms >= epoch_ms(TIMESTAMP '{START}')",
)
def start_timestamp(spark, sf):
    start = F.lit(START).cast("timestamp")
    return M.from_timestamp(log(spark, sf), start).select("topic", "partition", "offset")


@query(
    "start_offsets",
    f"""WITH m AS ({inputs.MESSAGES_SQL}),
p AS (SELECT topic, partition, max("offset") // 2 AS s FROM m WHERE partition <> 1 GROUP BY ALL)
SELECT m.topic, m.partition, "offset" FROM m LEFT JOIN p ON m.topic = p.topic AND m.partition = p.partition
WHERE s IS NULL OR "offset" >= s""",
)
def start_offsets(spark, sf):
    """Explicit start offsets; partition 1 has none and is read as a whole."""
    messages = log(spark, sf)
    half = F.floor(F.max("offset") / 2).alias("start_offset")
    positions = messages.filter("partition <> 1").groupBy("topic", "partition").agg(half)
    return M.from_offsets(messages, positions).select("topic", "partition", "offset")
