import json

import pytest
from pyspark.sql import functions as F

from tests.test_events import brute_late, random_events
from tidemill import schemas
from tidemill.operators import cells as C
from tidemill.operators import enrich as E
from tidemill.operators import messages as M
from tidemill.operators.clean import as_results, clean_posts
from tidemill.plans.enrichment import EnrichmentTables, enrich_messages, start_enrichment
from tidemill.plans.router import republished, start_router
from tidemill.queries.enrich import stand_in_scorer
from tidemill.session import shared_dir
from tidemill.sources.streams import Start, file_stream, kafka_options
from tidemill.streaming import windows as W
from tidemill.streaming.late import LATE, ON_TIME, LateSplit
from tidemill.streaming.logs import BatchLog
from tidemill.streaming.run import Snapshot, fan_out, log_sink, start, writer_sink

S = "This sentence is long enough to pass the gate"


def write_files(spark, label, frames):
    """One file per frame, in order, as the input of a stream."""
    path = shared_dir(spark, label)
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return path


def run(stream_query):
    stream_query.awaitTermination()


def post(i, text, rowkey=None):
    return (
        "media_test",
        json.dumps({"rowkey": rowkey or f"r{i}", "type": "1", "post_content": text}, ensure_ascii=False),
        0,
        i,
        None,
    )


def messages(spark, rows):
    return spark.createDataFrame(rows, schemas.MESSAGE)


BATCHES = [
    [post(0, f"{S} one."), post(1, "short"), ("media_test", "broken", 0, 2, None), post(3, f"{S} #x two words")],
    [post(4, f"{S} three", rowkey="r0"), post(5, f"{S} www.a.com"), post(6, f"{S} six"), post(7, f"{S} last", rowkey="r6")],
]


def dimension(spark, parents):
    return spark.createDataFrame(parents, "id string, parent_id string")


def test_enrichment_stream_equals_batch(spark):
    path = write_files(spark, "posts", [messages(spark, b) for b in BATCHES])
    base = shared_dir(spark, "out")
    tables = EnrichmentTables(base)
    entries = [("4", "A"), ("2", "B"), ("8", "A")]
    stream = file_stream(spark, path, files_per_batch=1)
    snapshot = Snapshot(lambda: dimension(spark, entries))
    run(start_enrichment(stream, snapshot, stand_in_scorer, tables, f"{base}/ck", once=True))

    both = messages(spark, [m for b in BATCHES for m in b])
    expected = as_results(enrich_messages(both, dimension(spark, entries), stand_in_scorer), "enrich_status")
    streamed = as_results(tables.results.read(spark), "enrich_status")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, expected.collect()))
    assert tables.results.read(spark).select("batch_id").distinct().count() == 2

    good = E.split_failures(enrich_messages(both, dimension(spark, entries), stand_in_scorer))[0]
    newest = {}
    for r in good.orderBy("offset").collect():
        newest[r.rowkey] = r.post_content
    assert {r.meta_id: r.post_content for r in tables.read_documents(spark).collect()} == newest
    cells = C.project_cells(tables.read_cells(spark), ["post_content"])
    assert {r.rowkey: r.post_content for r in cells.collect()} == newest
    failed = {r.rowkey for r in streamed.collect() if r.enrich_status == "failed"}
    assert {r.rowkey for r in tables.read_dead_letters(spark).collect()} == failed
    rejects = tables.rejects.read(spark)
    assert [r.value for r in rejects.collect()] == ["broken"]


def test_inline_lookup_on_a_stream(spark):
    ids = spark.createDataFrame([("a", ["4"]), ("b", ["x", "2"])], "k string, sub_industry_id array<string>")
    path = write_files(spark, "ids", [ids])
    stream = file_stream(spark, path, ids.schema)
    entries = dimension(spark, [("4", "A"), ("2", "B")])
    found = E.lookup_parents(stream, entries, ["k"])
    base = shared_dir(spark, "lookup")
    log = BatchLog(f"{base}/log")
    run(start(found, log_sink(log), f"{base}/ck", once=True))
    assert {r.k: r.parent_id for r in log.read(spark).collect()} == {"a": "A", "b": "B"}


def test_cleaning_on_a_stream(spark):
    posts = spark.createDataFrame([(f"{S} #x",), ("no",), (None,)], "post_content string")
    path = write_files(spark, "clean", [posts])
    base = shared_dir(spark, "cleaned")
    log = BatchLog(f"{base}/log")
    stream = clean_posts(file_stream(spark, path, posts.schema))
    run(start(stream, log_sink(log), f"{base}/ck", once=True))
    assert [r.post_content for r in log.read(spark).collect()] == [S]


def test_snapshot_is_read_again(spark):
    loads = []

    def load():
        loads.append(1)
        return dimension(spark, [("4", str(len(loads)))])

    snapshot = Snapshot(load, every=2)
    seen = [snapshot.at(n).first().parent_id for n in range(5)]
    assert seen == ["1", "1", "2", "2", "3"]


def test_dimension_changes_between_batches(spark):
    path = write_files(spark, "posts", [messages(spark, [post(i, f"{S} {'x' * (i + 1)}")]) for i in range(3)])
    dims = shared_dir(spark, "dims")
    dimension(spark, [("4", "old")]).write.parquet(dims)
    base = shared_dir(spark, "out")
    tables = EnrichmentTables(base)

    def load():
        frame = spark.read.parquet(dims)
        parents = {r.parent_id for r in frame.collect()}
        dimension(spark, [("4", f"new{len(parents)}")]).write.mode("append").parquet(dims)
        return frame

    stream = file_stream(spark, path, files_per_batch=1)
    run(start_enrichment(stream, Snapshot(load), stand_in_scorer, tables, f"{base}/ck", once=True))
    by_batch = {r.batch_id: r.parent_id for r in tables.results.read(spark).collect() if r.parent_id}
    assert set(by_batch.values()) <= {"old", "new1,old", "new1,new2,old"} and len(by_batch) >= 2


def test_resume_reads_only_new_input(spark):
    path = write_files(spark, "resume", [spark.range(5).toDF("n")])
    base = shared_dir(spark, "resumed")
    log = BatchLog(f"{base}/log")
    schema = spark.range(1).toDF("n").schema
    run(start(file_stream(spark, path, schema), log_sink(log), f"{base}/ck", once=True))
    spark.range(5, 8).toDF("n").coalesce(1).write.mode("append").parquet(path)
    for _ in range(2):
        run(start(file_stream(spark, path, schema), log_sink(log), f"{base}/ck", once=True))
    assert sorted(r.n for r in log.read(spark).collect()) == list(range(8))
    assert {(r.n, r.batch_id) for r in log.read(spark).collect() if r.n >= 5} == {(n, 1) for n in (5, 6, 7)}


def test_repeated_batch_counts_once(spark):
    log = BatchLog(shared_dir(spark, "replay"))
    for _ in range(2):
        log.write(spark.range(10), 0)
    log.write(spark.range(5), 1)
    assert log.read(spark).count() == 15
    assert log.latest(spark, ["id"]).count() == 10
    target = BatchLog(shared_dir(spark, "compact"))
    log.compact(spark, ["id"], target)
    assert {(r.id, r.batch_id) for r in target.read(spark).collect()} == {(i, 1) for i in range(10)}


def test_failed_sink_is_repaired_by_the_next_run(spark):
    path = write_files(spark, "fail", [spark.range(20).toDF("n")])
    schema = spark.range(1).toDF("n").schema
    base = shared_dir(spark, "failed")
    first, second = BatchLog(f"{base}/first"), BatchLog(f"{base}/second")
    calls = []

    def breaks_once(batch, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise OSError("sink down")
        second.write(batch, batch_id)

    process = fan_out(BatchLog(f"{base}/stage"), [log_sink(first), breaks_once])
    spark.sparkContext.setLogLevel("OFF")
    with pytest.raises(Exception, match="sink down"):
        run(start(file_stream(spark, path, schema), process, f"{base}/ck", once=True))
    spark.sparkContext.setLogLevel("ERROR")
    run(start(file_stream(spark, path, schema), process, f"{base}/ck", once=True))
    assert first.read(spark).count() == second.read(spark).count() == 20


def test_late_records_across_batches(spark):
    data = random_events(1200)
    schema = "k string, arrival long, ms long"
    frames = [spark.createDataFrame(data[i : i + 400], schema) for i in range(0, 1200, 400)]
    path = write_files(spark, "late", frames)
    base = shared_dir(spark, "split")
    split = LateSplit(base, "ms", "arrival", ["k"], block_rows=100)
    stream = file_stream(spark, path, frames[0].schema, files_per_batch=1)
    run(start(stream, split.process, f"{base}/ck", once=True))
    assert split.records.read(spark).select("batch_id").distinct().count() == 3
    flagged = {r.arrival for r in split.read(spark, LATE).collect()}
    assert flagged == brute_late(data)
    assert split.read(spark, ON_TIME).count() + len(flagged) == len(data)


@pytest.mark.parametrize("lateness", [0, 1])
def test_windows_are_refined_across_batches(spark, lateness):
    frames = [
        spark.createDataFrame([("a", t, v) for t, v in rows], "k string, s long, v long")
        for rows in ([(100, 1), (130, 2)], [(131, 3), (129, 4)], [(400, 5)])
    ]
    path = write_files(spark, "windows", frames)
    stream = file_stream(spark, path, frames[0].schema, files_per_batch=1)
    timed = W.with_watermark(W.with_event_time(stream, "s", "seconds"), lateness_ms=lateness)
    base = shared_dir(spark, "win")
    log = BatchLog(f"{base}/log")
    grouped = W.sliding_stream(timed, ["k"], "v", 60_000, 60_000, -8 * 3_600_000)
    run(start(grouped, log_sink(log), f"{base}/ck", output_mode="update", once=True))
    latest = log.latest(spark, ["k", "window_start"]).collect()
    assert {(r.window_start, r.n, r.sum) for r in latest} == {(60_000, 1, 1), (120_000, 3, 9), (360_000, 1, 5)}


def test_router(spark):
    rows = [
        ("dd", '{"name":"alice","age":1,"time":"t"}', 0, 0, None),
        ("dd", '{"name":"alice","age":2,"time":"t"}', 0, 1, None),
        ("topic1", '{"name":"x"}', 0, 0, None),
        ("topic1", "[1]", 0, 1, None),
        ("topic2", "né", 0, 0, None),
    ]
    path = write_files(spark, "route", [messages(spark, rows[:2]), messages(spark, rows[2:])])
    base = shared_dir(spark, "routed")
    stream = file_stream(spark, path, files_per_batch=1)
    run(start_router(stream, {"dd": "base:dd"}, base, f"{base}/ck", once=True))
    cells = BatchLog(f"{base}/cells").read(spark).collect()
    assert {(r.table, r.qualifier, r.value) for r in cells} == {
        ("base:dd", "adid", "alice"), ("base:dd", "adname", "2"), ("base:dd", "dn", "t"),
    }
    published = BatchLog(f"{base}/published").read(spark).collect()
    assert [(r.topic, bytes(r.value)) for r in published] == [("topic1", b'{"name":"x"}')]
    batch = M.to_row_topics(messages(spark, rows[2:3])).collect()
    assert [(r.topic, bytes(r.value)) for r in batch] == [("topic1", b'{"name":"x"}')]


def test_flows_feed_the_callers_sinks(spark):
    rows = [("dd", '{"name":"a","age":1,"time":"t"}', 0, 0, None), ("topic1", '{"name":"x"}', 0, 0, None)]
    base = shared_dir(spark, "sinks")
    stream = file_stream(spark, write_files(spark, "sinks", [messages(spark, rows)]))
    sink = writer_sink("parquet", republished, path=f"{base}/topic")
    run(start_router(stream, {"dd": "base:dd"}, base, f"{base}/ck", once=True, sinks=[sink]))
    sent = spark.read.parquet(f"{base}/topic").collect()
    assert [(r.topic, bytes(r.value)) for r in sent] == [("topic1", b'{"name":"x"}')]

    tables = EnrichmentTables(f"{base}/media")
    posts = file_stream(spark, write_files(spark, "sinkposts", [messages(spark, BATCHES[0])]))
    sink = writer_sink("parquet", path=f"{base}/index")
    snapshot = Snapshot(lambda: dimension(spark, [("4", "A")]))
    run(start_enrichment(posts, snapshot, stand_in_scorer, tables, f"{base}/ck2", once=True, sinks=[sink]))
    assert spark.read.parquet(f"{base}/index").count() == tables.results.read(spark).count() > 0


def test_kafka_options():
    options = kafka_options("h1:9092,h2:9092", ["a", "b"], Start.earliest())
    assert options == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "a,b", "startingOffsets": "earliest",
    }
    assert Start.latest().options == {"startingOffsets": "latest"}
    assert Start.timestamp(5).options == {"startingTimestamp": "5", "startingOffsetsByTimestampStrategy": "latest"}
    assert json.loads(Start.offsets({"t": {0: 5, 1: 7}}).options["startingOffsets"]) == {"t": {"0": 5, "1": 7}}


def test_streams_need_event_time_with_zone(spark):
    path = write_files(spark, "ntz", [spark.range(1).select(F.lit("2021-01-01 00:00:00").cast("timestamp_ntz").alias("ts"))])
    stream = file_stream(spark, path, "ts timestamp_ntz")
    timed = W.with_watermark(W.with_event_time(stream, "ts", "timestamp"))
    assert dict(timed.dtypes)["event_time"] == "timestamp"


def test_a_batch_without_rows_does_not_end_the_stream(spark, tmp_path):
    from tidemill.streaming.logs import BatchLog, refuse_stale
    from tidemill.streaming.run import fan_out, log_sink

    stage, out = BatchLog(f"{tmp_path}/stage", ("k",)), BatchLog(f"{tmp_path}/out")
    process = fan_out(stage, [log_sink(out)], lambda batch, n: batch.filter("v > 0"))
    for n, v in enumerate([1, -1, 2]):
        process(spark.createDataFrame([(v, "a")], "v int, k string"), n)
    assert sorted(r.v for r in out.read(spark).collect()) == [1, 2]
    with pytest.raises(ValueError):
        refuse_stale(spark, f"{tmp_path}/new", [stage])


def test_late_split_goes_on_after_an_empty_batch(spark, tmp_path):
    from tidemill.streaming.late import LateSplit

    split = LateSplit(f"{tmp_path}/late", "ms", "n", delay_ms=10)
    for k, rows in enumerate([[(1, 100)], [], [(2, 50), (3, 200)]]):
        split(spark.createDataFrame(rows, "n long, ms long"), k)
    assert [r.n for r in split.read(spark, "late").collect()] == [2]


@pytest.mark.parametrize("name", ["fan_out", "dead_letters_stream", "enrich_stream_cells", "enrich_stream_documents"])
def test_tables_that_are_folders_are_streamed_whole(spark, sf_dir, tmp_path, name):
    """Large tables are folders of files; a stream reads all of these, as it reads a table in one file."""
    from tidemill.queries import QUERIES

    for table in ("conversations", "nation"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    spark.read.parquet(f"{sf_dir}/conversations.parquet").limit(5).write.parquet(f"{tmp_path}/old_conversations.parquet")
    whole, parts = (sorted(map(str, QUERIES[name](spark, d).collect())) for d in (sf_dir, str(tmp_path)))
    assert whole and parts == whole
