"""The streaming forms, run over the given tables to their end.

Each query streams a table file, lets the stream work off its input and reads
what the sinks wrote below the shared directory.
"""

from pyspark.sql import functions as F

from tidemill.operators import clean
from tidemill.operators.enrich import lookup_parents
from tidemill.plans.enrichment import EnrichmentTables, start_enrichment
from tidemill.plans.router import start_router
from tidemill.queries import inputs
from tidemill.queries import sqltext as S
from tidemill.queries.decode import TIMED_SQL
from tidemill.queries.enrich import (
    CLEANED_MESSAGES_SQL,
    ENRICH_MESSAGES_SQL,
    dimension,
    stand_in_scorer,
)
from tidemill.queries.events import CENTS_SQL, HOUR_SQL, JITTER_SQL, JITTERED_SQL, LATE_BY_TYPE_SQL, MINUTE_SQL, cents, jittered
from tidemill.queries.keys import GROUPS_SQL
from tidemill.queries.registry import query, table
from tidemill.session import shared_dir
from tidemill.sources.committed import FORMAT, Committed, committed_sink, read_committed
from tidemill.sources.streams import file_stream
from tidemill.streaming import windows as W
from tidemill.streaming.final_windows import final_windows
from tidemill.streaming.keyed import KeyedTable
from tidemill.streaming.keyed_late import flag_late_stream
from tidemill.streaming.late import LATE, ON_TIME, LateSplit
from tidemill.streaming.logs import BatchLog
from tidemill.streaming.run import Snapshot, fan_out, log_sink, start
from tidemill.streaming.snapshots import BoundSnapshot


def table_stream(spark, sf, name):
    """A table is one file or a folder of files.  The path is a pattern that only the table matches: Spark lists
    what it finds there, where a plain path could not be a file and a filter on file names would miss a folder's."""
    schema = table(spark, sf, name).schema
    return file_stream(spark, f"{sf}/[{name[0]}]{name[1:]}.parquet", schema)


def finish(stream_query):
    stream_query.awaitTermination()


PARTS = 3


def work_off(spark, sf, name, order, begin):
    """Stream the whole table in parts that arrive one after another in the
    order of a number: each start resumes behind the part before it, so state,
    windows and positions pass from batch to batch."""
    rows = table(spark, sf, name)
    low, high = rows.agg(F.min(order), F.max(order)).first()
    step = 1 if low is None else (high - low) // PARTS + 1
    part = F.coalesce(F.floor((F.col(order) - F.lit(low)) / step), F.lit(0))
    folder = shared_dir(spark, name)
    for k in range(PARTS):
        rows.filter(part == k).write.mode("append").parquet(folder)
        finish(begin(file_stream(spark, folder, rows.schema)))


def part_sql(order, rows):
    """The part in which ``work_off`` delivers a row."""
    low, high = (f"(SELECT {f}({order}) FROM {rows})" for f in ("min", "max"))
    return f"(({order} - {low}) // (({high} - {low}) // {PARTS} + 1))"


def conversation_stream(spark, sf):
    return decorated_turns(table_stream(spark, sf, "conversations"))


def decorated_turns(turns):
    number = F.col("conv_id") * 7 + F.col("turn")
    return turns.select("conv_id", "turn", "role", inputs.decorated("text", number).alias("t"))


def _to_log(spark, stream, label):
    base = shared_dir(spark, label)
    log = BatchLog(f"{base}/log")
    finish(start(stream, log_sink(log), f"{base}/checkpoint", once=True))
    return log


@query(
    "stream_topic",
    f"""SELECT partition, "offset", value FROM ({inputs.MESSAGES_SQL}) WHERE topic = 'click'""",
)
def stream_topic(spark, sf):
    """One topic of the message log."""
    messages = inputs.messages(table_stream(spark, sf, "events")).filter("topic = 'click'")
    log = _to_log(spark, messages, "topic")
    return log.read(spark).select("partition", "offset", "value")


@query(
    "stream_topics",
    f"""SELECT topic, partition, "offset", value FROM ({inputs.MESSAGES_SQL}) WHERE topic IN ('click', 'view', 'error')""",
)
def stream_topics(spark, sf):
    """Several topics, each value with its topic."""
    wanted = F.col("topic").isin("click", "view", "error")
    messages = inputs.messages(table_stream(spark, sf, "events")).filter(wanted)
    log = _to_log(spark, messages, "topics")
    return log.read(spark).select("topic", "partition", "offset", "value")


@query("stream_resume", "SELECT event_id, event_type FROM events")
def stream_resume(spark, sf):
    """Each start resumes behind the committed input and adds only what is new."""
    base = shared_dir(spark, "resume")
    log = BatchLog(f"{base}/log")

    def begin(events):
        columns = events.select("event_id", "event_type")
        return start(columns, log_sink(log), f"{base}/checkpoint", once=True)

    work_off(spark, sf, "events", "event_id", begin)
    return log.read(spark).select("event_id", "event_type")


@query("replay_safe", "SELECT event_id, event_type FROM events")
def replay_safe(spark, sf):
    """Every batch is delivered twice, as after a failure, and counts once."""
    base = shared_dir(spark, "replay")
    log = BatchLog(f"{base}/log")

    def twice(batch, batch_id):
        log.write(batch, batch_id)
        log.write(batch, batch_id)

    events = table_stream(spark, sf, "events").select("event_id", "event_type")
    finish(start(events, twice, f"{base}/checkpoint", once=True))
    return log.read(spark).select("event_id", "event_type")


@query("replay_new_checkpoint", "SELECT event_id, event_type FROM events")
def replay_new_checkpoint(spark, sf):
    """A new checkpoint counts its batches from 0: over logs that have batches it is refused, and they keep them."""
    base = shared_dir(spark, "checkpoints")
    split = LateSplit(f"{base}/late", "event_ms", "event_id", ["event_type"])
    log = BatchLog(f"{base}/log")
    sinks = {"late": split.process, "log": log_sink(log), "both": fan_out(BatchLog(f"{base}/stage"), [log_sink(log)])}
    events = jittered(table_stream(spark, sf, "events"))
    for name in ("late", "log"):
        finish(start(events, sinks[name], f"{base}/checkpoint-{name}", once=True))
    for name, sink in sinks.items():
        try:
            finish(start(events.limit(1), sink, f"{base}/another-{name}", once=True))
        except ValueError:
            continue
        raise AssertionError(f"{name} was overwritten")
    late = split.records.read(spark).select("event_id", "event_type")
    return log.read(spark).select("event_id", "event_type").join(late, ["event_id", "event_type"])


@query("exactly_once_sink", "SELECT event_id, event_type FROM events")
def exactly_once_sink(spark, sf):
    """A sink outside Spark's writers: every batch is delivered twice and is there once."""
    base = shared_dir(spark, "outside")
    sink = committed_sink(f"{base}/sink", "events")

    def twice(batch, batch_id):
        sink(batch, batch_id)
        sink(batch, batch_id)

    def begin(events):
        return start(events.select("event_id", "event_type"), twice, f"{base}/checkpoint", once=True)

    work_off(spark, sf, "events", "event_id", begin)
    return read_committed(spark, f"{base}/sink", "event_id long, event_type string")


@query("exactly_once_stream", f"""SELECT topic, partition, "offset", value FROM ({inputs.MESSAGES_SQL})""")
def exactly_once_stream(spark, sf):
    """The same sink behind Spark's own stream writer."""
    base = shared_dir(spark, "outside")
    spark.dataSource.register(Committed)

    def begin(events):
        messages = inputs.messages(events).select("topic", "partition", "offset", "value")
        writer = messages.writeStream.format(FORMAT).option("path", f"{base}/sink").option("stream", "messages")
        return writer.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()

    work_off(spark, sf, "events", "event_id", begin)
    return read_committed(spark, f"{base}/sink", "topic string, partition int, offset long, value string")


def _windows(spark, sf, size_ms, slide_ms, offset_ms, lateness_ms):
    """Windows across the borders of the parts are refined, their state carried."""
    base = shared_dir(spark, "windows")
    log = BatchLog(f"{base}/log")

    def begin(events):
        events = events.select("ts", "event_type", cents())
        timed = W.with_watermark(W.with_event_time(events, "ts", "timestamp"), lateness_ms=lateness_ms)
        stream = W.sliding_stream(timed, ["event_type"], "cents", size_ms, slide_ms, offset_ms)
        return start(stream, log_sink(log), f"{base}/checkpoint", output_mode="update", once=True)

    work_off(spark, sf, "events", "event_id", begin)
    latest = log.latest(spark, ["event_type", "window_start"])
    return latest.select(
        "event_type", "window_start", "window_end", "n", "sum", "min", "max", "avg"
    )


@query("watermark_windows", HOUR_SQL)
def watermark_windows(spark, sf):
    return _windows(spark, sf, 3_600_000, 300_000, 0, 0)


@query("allowed_lateness", MINUTE_SQL)
def allowed_lateness(spark, sf):
    return _windows(spark, sf, 60_000, 10_000, -8 * 3_600_000, 1)


FINAL_SIZE, FINAL_SLIDE = 3_600_000, 300_000


def final_windows_sql(delay_ms):
    """A row counts if its pane ends behind the watermark of the parts before; a window is told if the last one reached it."""
    return f"""WITH e AS (SELECT event_type, {CENTS_SQL} AS cents, {part_sql('event_id', 'events')} AS part,
epoch_us(ts) // 1000 - {JITTER_SQL} AS ms, ms // {FINAL_SLIDE} * {FINAL_SLIDE} AS pane FROM events),
w AS (SELECT part + 1 AS part, max(max(ms)) OVER (ORDER BY part) - {delay_ms} AS mark FROM e GROUP BY e.part),
r AS (SELECT e.* FROM e LEFT JOIN w ON w.part = e.part WHERE mark IS NULL OR pane + {FINAL_SLIDE} > mark)
SELECT event_type, s AS window_start, s + {FINAL_SIZE} AS window_end, count(*) AS n, sum(cents)::BIGINT AS sum, min(cents) AS min,
max(cents) AS max, sum(cents)::DOUBLE / count(*) AS avg
FROM (SELECT *, unnest(range(pane - {FINAL_SIZE - FINAL_SLIDE}, pane + 1, {FINAL_SLIDE})) AS s FROM r)
WHERE s + {FINAL_SIZE} <= (SELECT max(mark) FROM w) GROUP BY ALL"""


def _final_windows(spark, sf, lateness_ms):
    base = shared_dir(spark, "final")
    log = BatchLog(f"{base}/log")

    def begin(events):
        shift = F.unix_millis(F.col("ts").cast("timestamp")) - F.expr(JITTER_SQL)
        rows = events.select("event_type", shift.alias("ms"), cents())
        timed = W.with_watermark(W.with_event_time(rows, "ms", "millis"), lateness_ms=lateness_ms)
        stream = final_windows(timed, ["event_type"], "cents", FINAL_SIZE, FINAL_SLIDE)
        return start(stream, log_sink(log), f"{base}/checkpoint", once=True)

    work_off(spark, sf, "events", "event_id", begin)
    return log.read(spark).drop("batch_id")


@query("final_windows", final_windows_sql(2500))
def windows_told_once(spark, sf):
    """Each window once, when the watermark has reached its end; what comes later is left out."""
    return _final_windows(spark, sf, 0)


@query("final_windows_late", final_windows_sql(2500 + 3_600_000))
def windows_told_later(spark, sf):
    """With an hour of allowed lateness the rows that were set back count, and the last windows are told later."""
    return _final_windows(spark, sf, 3_600_000)


@query("late_records_stream", LATE_BY_TYPE_SQL)
def late_records_stream(spark, sf):
    """The greatest event times pass from part to part."""
    base = shared_dir(spark, "late")
    split = LateSplit(base, "event_ms", "event_id", ["event_type"], block_rows=1000)

    def begin(events):
        return start(jittered(events), split.process, f"{base}/checkpoint", once=True)

    work_off(spark, sf, "events", "event_id", begin)
    flagged = [
        split.read(spark, output).select(
            "event_id", "event_type", "event_ms", F.lit(output == LATE).alias("late")
        )
        for output in (ON_TIME, LATE)
    ]
    return flagged[0].unionByName(flagged[1])


def _late_keyed(spark, sf, arrival):
    base = shared_dir(spark, "keyed")
    log = BatchLog(f"{base}/log")

    def begin(events):
        flagged = flag_late_stream(jittered(events), "event_ms", ["event_type"], arrival)
        return start(flagged, log_sink(log), f"{base}/checkpoint", once=True)

    work_off(spark, sf, "events", "event_id", begin)
    return log.read(spark).select("event_id", "event_type", "event_ms", "late")


@query("late_records_keyed", LATE_BY_TYPE_SQL)
def late_records_keyed(spark, sf):
    """The greatest event time as state of the key, over three starts."""
    return _late_keyed(spark, sf, "event_id")


@query(
    "late_records_unordered",
    f"""SELECT event_id, event_type, event_ms, coalesce(event_ms <= max(event_ms) OVER (PARTITION BY event_type ORDER BY part
RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 2500, false) AS late
FROM (SELECT *, {part_sql('event_id', 'events')} AS part FROM ({JITTERED_SQL}))""",
)
def late_records_unordered(spark, sf):
    """Without an arrival number: against what came in earlier batches."""
    return _late_keyed(spark, sf, None)


@query(
    "lookup_changing_dimension",
    f"""SELECT o_orderkey, part, coalesce((SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT DISTINCT (n_regionkey + part)::VARCHAR AS p
FROM nation WHERE n_nationkey IN (o_custkey % 30, length(o_orderpriority)))), '') AS parent_id
FROM (SELECT *, {part_sql('o_orderkey', 'orders')} AS part FROM orders)""",
)
def lookup_changing_dimension(spark, sf):
    """Before each part the parents change.  A batch reads the version bound to it, also when it runs again later."""
    base = shared_dir(spark, "versions")
    kept = KeyedTable(f"{base}/nations", "id string, parent_id string", ["id"], 4)
    snapshot, log = BoundSnapshot(spark, kept, f"{base}/bound"), BatchLog(f"{base}/log")
    nations, part, stage = table(spark, sf, "nation"), 0, BatchLog(f"{base}/orders")

    def look_up(batch_id):
        ids = F.array((F.col("o_custkey") % 30).cast("string"), F.length("o_orderpriority").cast("string"))
        orders = stage.read_batch(spark, batch_id).select("o_orderkey", ids.alias("ids"))
        found = lookup_parents(orders, snapshot.at(batch_id), ids="ids")
        log.write(found.select("o_orderkey", "parent_id"), batch_id)

    def process(batch, batch_id):
        stage.write(batch, batch_id)
        look_up(batch_id)
        if batch_id:  # the batch before runs again, and the dimension has changed meanwhile
            look_up(batch_id - 1)

    def begin(orders):
        nonlocal part
        parents = (F.col("n_regionkey") + part).cast("string").alias("parent_id")
        kept.upsert(nations.select(F.col("n_nationkey").cast("string").alias("id"), parents))
        part += 1
        return start(orders, process, f"{base}/checkpoint", once=True, logs=[stage, log])

    work_off(spark, sf, "orders", "o_orderkey", begin)
    return log.read(spark).select("o_orderkey", F.col("batch_id").cast("long").alias("part"), "parent_id")


@query(
    "route_stream",
    f"""WITH m AS (SELECT * FROM ({TIMED_SQL}) WHERE {inputs.IS_OBJECT_SQL}),
n AS (SELECT *, lpad(md5(json_extract_string(value, '$.name')), 35, '0') AS h FROM m
WHERE topic IN ('click', 'view') AND ok),
k AS (SELECT CASE topic WHEN 'click' THEN 'web:clicks' ELSE 'web:views' END AS target, {GROUPS_SQL} AS g, *
FROM n QUALIFY row_number() OVER (PARTITION BY topic, json_extract_string(value, '$.name')
ORDER BY partition DESC, "offset" DESC) = 1),
r AS (SELECT target, ltrim(g, '0') AS rowkey, json_extract_string(value, '$.name') AS adid,
json_extract_string(value, '$.age') AS adname, json_extract_string(value, '$.time') AS dn FROM k)
SELECT target, rowkey || '/' || qualifier AS item, value FROM r UNPIVOT (value FOR qualifier IN (adid, adname, dn))
UNION ALL SELECT topic, NULL, value FROM m WHERE topic NOT IN ('click', 'view')""",
)
def route_stream(spark, sf):
    """Two topics to cell tables, the others published again."""
    base = shared_dir(spark, "router")
    messages = inputs.messages(table_stream(spark, sf, "events"))
    tables = {"click": "web:clicks", "view": "web:views"}
    finish(start_router(messages, tables, base, f"{base}/checkpoint", once=True))
    cells = BatchLog(f"{base}/cells").read(spark)
    published = BatchLog(f"{base}/published").read(spark)
    return cells.select(
        F.col("table").alias("target"), F.concat_ws("/", "rowkey", "qualifier").alias("item"), "value"
    ).unionByName(
        published.select(
            F.col("topic").alias("target"),
            F.lit(None).cast("string").alias("item"),
            F.decode("value", "UTF-8").alias("value"),
        )
    )


@query(
    "fan_out",
    S.clean_chain(inputs.CONVERSATIONS_SQL)
    + """, k AS (SELECT conv_id || '-' || turn AS rowkey, t FROM cleaned WHERE t <> '')
SELECT 'cells' AS sink, rowkey, t AS post_content FROM k
UNION ALL SELECT 'documents', rowkey, t FROM k""",
)
def fan_out_stream(spark, sf):
    """One cleaned stream to two sinks."""
    base = shared_dir(spark, "fanout")
    stage, first, second = (BatchLog(f"{base}/{n}") for n in ("stage", "cells", "documents"))
    posts = clean.clean_posts(
        conversation_stream(spark, sf).select(
            F.concat_ws("-", "conv_id", "turn").alias("rowkey"), F.col("t").alias("post_content")
        )
    )
    process = fan_out(stage, [log_sink(first), log_sink(second)])
    finish(start(posts, process, f"{base}/checkpoint", once=True))
    sinks = [
        log.read(spark).select(F.lit(name).alias("sink"), "rowkey", "post_content")
        for name, log in (("cells", first), ("documents", second))
    ]
    return sinks[0].unionByName(sinks[1])


def _run_enrichment(spark, sf):
    base = shared_dir(spark, "enrichment")
    tables = EnrichmentTables(base)
    messages = inputs.post_messages(conversation_stream(spark, sf))
    snapshot = Snapshot(lambda: dimension(spark, sf))
    finish(
        start_enrichment(messages, snapshot, stand_in_scorer, tables, f"{base}/checkpoint", once=True)
    )
    return tables


@query("enrich_stream", ENRICH_MESSAGES_SQL)
def enrich_stream(spark, sf):
    """The streaming flow gives what the batch flow gives, over several batches;
    the dimension is read again for each."""
    base = shared_dir(spark, "enrichment")
    tables = EnrichmentTables(base)
    snapshot = Snapshot(lambda: dimension(spark, sf))

    def begin(turns):
        messages = inputs.post_messages(decorated_turns(turns))
        return start_enrichment(messages, snapshot, stand_in_scorer, tables, f"{base}/checkpoint", once=True)

    work_off(spark, sf, "conversations", "conv_id", begin)
    return clean.as_results(tables.results.read(spark), "enrich_status")


FIELDS = "type, post_user_name, media, sub_industry_id, parent_id, post_content"


@query(
    "enrich_stream_cells",
    f"""WITH e AS ({ENRICH_MESSAGES_SQL}), k AS (SELECT * FROM e WHERE enrich_status <> 'failed')
SELECT rowkey, qualifier, value FROM k UNPIVOT (value FOR qualifier IN ({FIELDS}))""",
)
def enrich_stream_cells(spark, sf):
    cells = _run_enrichment(spark, sf).read_cells(spark)
    return cells.select("rowkey", "qualifier", "value")


@query(
    "enrich_stream_documents",
    f"""WITH e AS ({ENRICH_MESSAGES_SQL})
SELECT rowkey AS meta_id, rowkey, {FIELDS}, dw_gofish_media_id FROM e WHERE enrich_status <> 'failed'""",
)
def enrich_stream_documents(spark, sf):
    documents = _run_enrichment(spark, sf).read_documents(spark)
    return documents.select("meta_id", "rowkey", *FIELDS.split(", "), "dw_gofish_media_id")


@query(
    "dead_letters_stream",
    CLEANED_MESSAGES_SQL
    + " SELECT rowkey, 'failed' AS enrich_status FROM cleaned WHERE t <> '' AND length(t) % 7 = 0",
)
def dead_letters_stream(spark, sf):
    letters = _run_enrichment(spark, sf).read_dead_letters(spark)
    return letters.select("rowkey", "enrich_status")
