"""Sinks that hold a batch once, tables kept by key, versions bound to batches, state by key."""

import json
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tests.test_events import brute_late, random_events
from tests.test_streams import run, write_files
from tidemill.operators import enrich as E
from tidemill.operators.calls import TIMEOUT, Inputs, timed_calls, timed_stream
from tidemill.queries.enrich import stand_in_scorer
from tidemill.session import shared_dir
from tidemill.sources.committed import FORMAT, Committed, Place, committed_files, committed_sink, read_committed, sweep
from tidemill.sources.streams import file_stream
from tidemill.streaming.keyed import Conflict, KeyedTable
from tidemill.streaming.keyed_late import flag_late_stream
from tidemill.streaming.late import LateSplit
from tidemill.streaming.logs import BatchLog
from tidemill.streaming.run import fan_out, log_sink, start
from tidemill.streaming.snapshots import BoundSnapshot

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture
def quiet(spark):
    spark.sparkContext.setLogLevel("OFF")
    yield
    spark.sparkContext.setLogLevel("ERROR")


# -- a sink outside Spark's writers


def failing(rows, at):
    return rows.withColumn("n", F.when(F.col("n") == at, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))


def numbers(spark, low, high, parts=4):
    return spark.range(low, high, 1, parts).toDF("n")


def test_repeated_and_half_failed_batches_are_there_once(spark, quiet):
    path = shared_dir(spark, "sink")
    sink = committed_sink(path, "a")
    with pytest.raises(Exception, match="lost"):
        sink(failing(numbers(spark, 0, 100_000), 99_999), 0)  # three tasks are done, the fourth fails near its end
    assert read_committed(spark, path, "n long").count() == 0
    for _ in range(3):
        sink(numbers(spark, 0, 100_000), 0)
    sink(numbers(spark, 100_000, 100_010), 1)
    with pytest.raises(Exception, match="lost"):
        sink(failing(numbers(spark, 200_000, 200_010), 200_009), 2)
    assert sorted(r.n for r in read_committed(spark, path, "n long").collect()) == list(range(100_010))
    assert {(s, b) for s, b, _ in committed_files(path)} == {("a", 0), ("a", 1)}


def test_streams_are_kept_apart_and_lost_files_swept(spark):
    path = shared_dir(spark, "sink")
    committed_sink(path, "a")(numbers(spark, 0, 10), 0)
    committed_sink(path, "b")(numbers(spark, 0, 5), 0)  # another checkpoint counts from 0 too
    assert read_committed(spark, path, "n long").count() == 15
    assert read_committed(spark, path, "n long", "b").count() == 5
    system, base = Place(path, "a").system()
    with system.open_output_stream(f"{base}/data/a/lost.parquet") as file:
        file.write(b"half a file")
    assert read_committed(spark, path, "n long", "a").count() == 10
    assert (sweep(path, "a"), sweep(path, "a")) == (1, 0)
    assert read_committed(spark, path, "n long", "a").count() == 10
    for name in ("", "a/b", ".a"):
        with pytest.raises(ValueError):
            Place(path, name)


def test_empty_batches_shapes_and_types(spark):
    path = shared_dir(spark, "sink")
    sink = committed_sink(path, "a", lambda rows, n: rows.withColumn("batch", F.lit(n)))
    rows = spark.createDataFrame([(1, "x", None, bytearray(b"1")), (2, None, 2.5, None)], "n long, s string, d double, b binary")
    sink(rows.where("n > 5"), 0)
    sink(rows, 1)
    got = read_committed(spark, path, "n long, s string, d double, b binary, batch int")
    assert sorted(map(tuple, got.collect())) == [(1, "x", None, b"1", 1), (2, None, 2.5, None, 1)]
    with pytest.raises(Exception, match="append"):
        rows.write.format(FORMAT).mode("overwrite").option("path", path).option("stream", "a").option("batch", "0").save()


def test_spark_writes_the_sink_itself(spark):
    path, out = write_files(spark, "in", [numbers(spark, 0, 10), numbers(spark, 10, 30)]), shared_dir(spark, "sink")
    spark.dataSource.register(Committed)
    stream = file_stream(spark, path, "n long", files_per_batch=1)
    writer = stream.writeStream.format(FORMAT).option("path", out).option("stream", "s")
    for _ in range(2):
        run(writer.option("checkpointLocation", f"{out}-ck").trigger(availableNow=True).start())
    assert sorted(r.n for r in read_committed(spark, out, "n long").collect()) == list(range(30))
    assert {b for _, b, _ in committed_files(out)} == {0, 1}


# -- logs and checkpoints


def test_a_new_checkpoint_leaves_every_log_alone(spark, tmp_path):
    path = write_files(spark, "log", [spark.createDataFrame([("a", 1, 100)], "k string, n long, ms long")])
    split = LateSplit(f"{tmp_path}/late", "ms", "n", ["k"])
    log, stage, own = (BatchLog(f"{tmp_path}/{x}") for x in ("log", "stage", "own"))

    def mine(batch, batch_id):
        own.write(batch, batch_id)

    begun = {"late": (split, ()), "method": (LateSplit(f"{tmp_path}/late2", "ms", "n").process, ()), "fan": (fan_out(stage, [log_sink(log)]), ()), "mine": (mine, [own])}
    stream = lambda: file_stream(spark, path, "k string, n long, ms long")
    for name, (process, logs) in begun.items():
        run(start(stream(), process, f"{tmp_path}/ck-{name}", once=True, logs=logs))
        run(start(stream(), process, f"{tmp_path}/ck-{name}", once=True, logs=logs))
        with pytest.raises(ValueError, match="another checkpoint"):
            start(stream(), process, f"{tmp_path}/new-{name}", once=True, logs=logs)
    assert [x.read(spark).count() for x in (split.records, log, stage, own)] == [1, 1, 1, 1]
    later = BatchLog(f"{tmp_path}/compacted")
    later.write(spark.range(3), 7)  # no batch 0
    with pytest.raises(ValueError, match="another checkpoint"):
        start(stream(), log_sink(later), f"{tmp_path}/ck-later", once=True)


# -- late records by key


def keyed_late(spark, frames, arrival, restart=False):
    base = shared_dir(spark, "keyed")
    log, path = BatchLog(f"{base}/log"), shared_dir(spark, "in")

    def begin():
        stream = file_stream(spark, path, frames[0].schema, files_per_batch=1)
        run(start(flag_late_stream(stream, "ms", ["k"], arrival), log_sink(log), f"{base}/ck", once=True))

    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
        if restart:
            begin()
    if not restart:
        begin()
    return log.read(spark)


@pytest.mark.parametrize("restart", [False, True])
def test_late_by_state_of_the_key(spark, restart):
    data = random_events(900)
    frames = [spark.createDataFrame(data[i : i + 300], "k string, arrival long, ms long") for i in range(0, 900, 300)]
    found = keyed_late(spark, frames, "arrival", restart)
    assert found.count() == 900 and found.select("batch_id").distinct().count() == 3
    assert {r.arrival for r in found.where("late").collect()} == brute_late(data)


def test_late_without_arrival_numbers(spark):
    big = (1 << 62) + 1
    batches = [
        [("a", 100_000, big), ("a", 1, None), (None, 50_000, 1), ("b", None, 2)],
        [("a", 97_500, 3), ("a", 97_501, big + 1), ("a", 500_000, 4), ("a", 97_502, 5), (None, 47_500, 6), ("b", 1, 7)],
        [("a", 497_500, 8), ("a", 497_501, 9), (None, 47_501, None), ("b", None, 10)],
    ]
    frames = [spark.createDataFrame(b, "k string, ms long, id long") for b in batches]
    got = sorted(((r.k, r.ms, r.id, r.late) for r in keyed_late(spark, frames, None).collect()), key=repr)
    late = {("a", 97_500, 3), (None, 47_500, 6), ("a", 497_500, 8)}
    assert got == sorted(((*row, row in late) for b in batches for row in b), key=repr)


def test_a_running_maximum_wants_a_key(spark):
    with pytest.raises(ValueError, match="LateSplit"):
        flag_late_stream(spark.range(1), "id", [])


# -- tables kept by key


def table_of(spark, schema="id long, a string, b long", key=("id",), buckets=4):
    return KeyedTable(shared_dir(spark, "kept"), schema, list(key), buckets)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_replays_and_readers_of_a_keyed_table(spark):
    kept = table_of(spark)
    first = spark.createDataFrame([(k, f"a{k}", k) for k in range(40)], "id int, a string, b int")  # narrower keys
    assert kept.read(spark).count() == 0 and kept.version(spark).number == -1
    assert kept.upsert(first, stream="s", batch=0) and not kept.upsert(first, stream="s", batch=0)
    reader = kept.read(spark)
    change = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (99, "new", 0)], "id long, a string, o int")
    assert kept.upsert(change, F.col("o"), stream="s", batch=1)
    assert not kept.upsert(change, F.col("o"), stream="s", batch=1) and not kept.upsert(first, stream="s", batch=0)
    assert kept.version(spark).number == 1
    assert rows_of(reader) == sorted([(k, f"a{k}", k) for k in range(40)], key=repr)
    want = {k: (k, f"a{k}", k) for k in range(40)} | {1: (1, "y", None), 99: (99, "new", None)}
    assert rows_of(kept.read(spark)) == sorted(want.values(), key=repr)
    assert rows_of(kept.read(spark, 0)) == rows_of(reader)
    assert kept.supply(spark.createDataFrame([(1, None), (2, 7), (100, 8)], "id long, b long"), stream="other", batch=0)
    want |= {1: (1, "y", None), 2: (2, "a2", 7), 100: (100, None, 8)}
    assert {r[0]: tuple(r) for r in kept.read(spark).collect()} == want and kept.read(spark).count() == len(want)
    assert {r[0] for r in kept.get(spark.createDataFrame([(1,), (100,), (5000,)], "id int")).collect()} == {1, 100}


def test_a_failed_update_changes_nothing(spark, quiet):
    kept = table_of(spark)
    kept.upsert(spark.createDataFrame([(1, "a", 1)], "id long, a string, b long"), stream="s", batch=0)
    bad = spark.createDataFrame([(1, "z", 2), (None, "z", 2)], "id long, a string, b long")
    with pytest.raises(Exception, match="key is NULL"):
        kept.upsert(bad, stream="s", batch=1)
    assert rows_of(kept.read(spark)) == [(1, "a", 1)]
    assert kept.upsert(bad.where("id = 1"), stream="s", batch=1) and rows_of(kept.read(spark)) == [(1, "z", 2)]
    assert kept.vacuum(spark, keep=1) == 2  # the version before, and what the failed update left
    assert rows_of(kept.read(spark)) == [(1, "z", 2)]


def test_two_writers_do_not_lose_an_update(spark):
    kept = table_of(spark)
    change = spark.createDataFrame([(1, "a", 1)], "id long, a string, b long")

    def meanwhile(current, delta):
        kept.upsert(change, stream="second", batch=0)
        return delta

    with pytest.raises(Conflict):
        kept.update(spark.createDataFrame([(2, "b", 2)], change.schema), meanwhile, stream="first", batch=0)
    assert rows_of(kept.read(spark)) == [(1, "a", 1)]
    with pytest.raises(ValueError, match="buckets"):
        KeyedTable(kept.path, kept.schema, kept.key, 8).read(spark)


def test_only_touched_buckets_are_written(spark):
    kept = table_of(spark, buckets=16)
    kept.upsert(spark.range(1000).select("id", F.lit("a").alias("a"), F.lit(1).alias("b")))
    before = kept.version(spark).folders
    kept.upsert(spark.createDataFrame([(5, "x", 0)], "id long, a string, b long"))
    after = kept.version(spark).folders
    assert sum(before[b] != after[b] for b in before) == 1 and len(before) == 16
    assert rows_of(kept.get(spark.createDataFrame([(5,)], "id long"))) == [(5, "x", 0)]


def test_a_column_may_be_called_bucket(spark):
    kept = table_of(spark, "bucket string, bucket_ long", ("bucket",))
    kept.upsert(spark.createDataFrame([("a", 1), ("b", 2)], "bucket string, bucket_ long"))
    kept.upsert(spark.createDataFrame([("b", 3)], "bucket string, bucket_ long"))
    assert rows_of(kept.read(spark)) == [("a", 1), ("b", 3)]


def test_a_stream_keeps_a_table(spark):
    frames = [spark.createDataFrame(rows, "id long, a string, b long") for rows in ([(1, "a", 1), (2, "b", 1)], [(2, "c", 2)], [(3, "d", 3), (1, "e", 3)])]
    path, kept = write_files(spark, "in", frames), table_of(spark)
    stream = file_stream(spark, path, frames[0].schema, files_per_batch=1)
    for _ in range(2):
        run(start(stream, kept.sink("s", kept.upsert, order=F.col("b")), f"{kept.path}-ck", once=True))
    assert rows_of(kept.read(spark)) == [(1, "e", 3), (2, "c", 2), (3, "d", 3)] and kept.version(spark).number == 2


def test_a_batch_reads_the_version_bound_to_it(spark):
    kept = table_of(spark, "id string, parent_id string")
    put = lambda parent: kept.upsert(spark.createDataFrame([("4", parent)], "id string, parent_id string"))
    path = shared_dir(spark, "bound")
    snapshot = BoundSnapshot(spark, kept, path)
    assert snapshot.at(0).count() == 0  # there was no version
    put("old")
    assert snapshot.at(1).first().parent_id == "old"
    put("new")
    again = BoundSnapshot(spark, kept, path)  # another driver
    assert again.at(0).count() == 0
    assert [again.at(n).first().parent_id for n in (1, 2, 1)] == ["old", "new", "old"]
    put("newest")
    slow = BoundSnapshot(spark, kept, f"{path}-slow", every=3)
    assert slow.version_of(3) == 2
    put("last")
    assert [slow.version_of(n) for n in (5, 6)] == [2, 3]


# -- calls


def test_calls_in_order_with_a_deadline():
    import threading
    import time

    running, most, lock = [0], [0], threading.Lock()

    def call(n):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            if n % 10 == 3:
                time.sleep(1.5)
            elif n % 10 == 4:
                raise OSError(f"no {n}")
            else:
                time.sleep(0.01 * (5 - n % 5))
            return n * n
        finally:
            with lock:
                running[0] -= 1

    began = time.monotonic()
    found = timed_calls(call, range(40), deadline_seconds=0.5, in_flight=4)
    took = time.monotonic() - began
    assert [o.value for o in found] == [None if n % 10 in (3, 4) else n * n for n in range(40)]
    assert [o.error for o in found] == [TIMEOUT if n % 10 == 3 else f"OSError: no {n}" if n % 10 == 4 else None for n in range(40)]
    assert took < 4 and most[0] <= 4 + 4  # four at once, beside those given up
    assert timed_calls(call, [], 1.0) == [] and timed_calls(lambda n: n, [1, 2])[1].value == 2
    for wrong in (lambda n: n.missing, lambda n: n + "a"):
        for deadline in (None, 1.0):
            with pytest.raises((TypeError, AttributeError)):
                timed_calls(wrong, [1, 2, 3], deadline)
    with pytest.raises(ValueError):
        timed_calls(call, [1], 0)


def _slow_or_wrong():
    import time

    def score(texts):
        if any("hang" in t for t in texts):
            time.sleep(3)
        if any("down" in t for t in texts):
            raise ConnectionError("refused")
        return ['{"msg":"成功","data":[{"7":1}]}' for _ in texts]

    return score


def _broken_scorer():
    return lambda texts: texts.nothing


def test_hanging_calls_cost_their_own_texts(spark):
    texts = [f"fine {k}" for k in range(20)] + ["hang", "down", "", None]
    posts = spark.createDataFrame([(k, t, "mine") for k, t in enumerate(texts)], "k int, post_content string, _s string").coalesce(1)
    scored = E.classify(posts, _slow_or_wrong, max_attempts=2, deadline_seconds=0.7, in_flight=3, call_texts=1)
    got = {r.k: r for r in scored.collect()}
    assert [got[k].classify_status for k in range(24)] == ["ok"] * 20 + ["timeout", "failed", "skipped", "skipped"]
    assert got[20].classify_error == TIMEOUT and got[21].classify_error == "ConnectionError: refused" and got[0].classify_error is None
    assert {r._s for r in got.values()} == {"mine"} and got[20].attempts == 2
    found = E.lookup_parents(scored, spark.createDataFrame([("7", "P")], "id string, parent_id string"))
    assert {r.k for r in E.split_failures(found)[1].collect()} == {20, 21}


def test_errors_of_the_program_fail_the_task(spark, quiet):
    posts = spark.createDataFrame([("a",)], "post_content string")
    with pytest.raises(Exception, match="nothing"):
        E.classify(posts, _broken_scorer).collect()


def _counting(folder):
    def make():
        import os
        import uuid

        inner = stand_in_scorer()

        def score(texts):
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as file:
                file.write(str(len(texts)))
            return inner(texts)

        return score

    return make


def test_each_distinct_text_is_sent_once(spark, tmp_path):
    calls = lambda: sum(int(p.read_text()) for p in tmp_path.iterdir())
    texts = ["hot text one"] * 500 + [f"text number {k} {'x' * (k % 9)}" for k in range(60)] + ["seven77", None, ""]
    posts = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, post_content string").repartition(5)
    replies = E.Replies(shared_dir(spark, "replies"))
    scorer, plain = _counting(str(tmp_path)), E.classify(posts, stand_in_scorer, max_attempts=1)
    columns = ["k", "post_content", "sub_industry_id", "classify_status"]
    want = sorted(map(repr, plain.select(*columns).collect()))
    first = E.classify_distinct(posts, scorer, replies, max_attempts=1)
    assert sorted(map(repr, first.select(*columns).collect())) == want
    sent = len({t for t in texts if t})
    assert calls() == sent
    again = E.classify_distinct(posts, scorer, replies, max_attempts=1)
    assert sorted(map(repr, again.select(*columns).collect())) == want
    failed = len({r.post_content for r in plain.where("classify_status = 'failed'").collect()})
    assert failed and calls() == sent + failed  # only those without a reply
    assert {r.attempts for r in again.where("classify_status = 'ok'").collect()} == {0}
    assert E.classify_distinct(posts.limit(0), scorer, replies).count() == 0


# -- columns of the caller's


@pytest.mark.parametrize("splits", [1, 7])
@pytest.mark.parametrize("strategy", ["inline", "join", "reduced"])
def test_lookups_keep_columns_of_any_name(spark, monkeypatch, strategy, splits):
    names = ["_row", "_ids", "_parents", "_n_ids", "_table", "_d", "__row"]
    rows = [(k, ["a"] if k % 2 else ["z"], *range(7)) for k in range(20)]
    posts = spark.createDataFrame(rows, "k int, sub_industry_id array<string>, " + ", ".join(f"{n} int" for n in names)).repartition(splits)
    entries = spark.createDataFrame([("a", "P"), *[(f"x{k}", "R") for k in range(8)]], "id string, parent_id string")
    if strategy == "reduced":
        monkeypatch.setattr(E, "MAX_INLINE_ENTRIES", 5)
    found = E.lookup_parents(posts, entries, strategy="auto" if strategy == "reduced" else strategy)
    assert found.columns == ["k", *names, "sub_industry_id", "parent_id", "enrich_status"]
    assert sorted(map(tuple, found.collect())) == [
        (k, *range(7), "a" if k % 2 else "z", "P" if k % 2 else "", "ok" if k % 2 else "unmatched") for k in range(20)
    ]


def test_no_call_waits_for_a_part_before_its_own():
    def call(n):
        time.sleep(0.4 if n % 10 == 0 else 0)
        return n

    parts = [range(k, k + 10) for k in range(0, 120, 10)]  # each with one call that hangs
    began = time.monotonic()
    found = list(timed_stream(call, map(Inputs, parts), deadline_seconds=0.2, in_flight=4))
    took = time.monotonic() - began
    assert [[o.value if o.error is None else o.error for o in part.outcomes] for part in found] == [[TIMEOUT, *p[1:]] for p in parts]
    assert took < 1.2  # 12 deadlines in 4 places; part by part it were 12 in a row, 2.4 s


def test_parts_ahead_of_a_hanging_one_are_bounded():
    read = []

    def given():
        for k in range(200):
            read.append(k)
            yield Inputs([k])

    found = timed_stream(lambda n: time.sleep(0.3 if n == 0 else 0), given(), deadline_seconds=5, in_flight=2, ahead=20)
    next(found)
    assert len(read) <= 21
    assert len(list(found)) == 199


def test_an_answer_that_came_late_counts_as_none():
    def given():
        yield Inputs([0.3])
        time.sleep(0.6)  # the next part is long in coming; meanwhile the first call ends, too late
        yield Inputs([0.0])

    found = list(timed_stream(lambda s: time.sleep(s), given(), deadline_seconds=0.15, in_flight=2))
    assert [p.outcomes[0].error for p in found] == [TIMEOUT, None]


def test_waiting_tasks_get_the_same_number_of_rows(spark):
    lumps = spark.range(0, 900, 1, 1).union(spark.range(900, 910, 1, 30)).select(F.col("id").cast("string").alias("post_content"))
    scored = E.classify(lumps, _slow_or_wrong, deadline_seconds=5.0).withColumn("task", F.spark_partition_id())
    rows = [r["count"] for r in scored.groupBy("task").count().collect()]
    assert sum(rows) == 910 and max(rows) <= 2 * min(rows) and len(rows) >= spark.sparkContext.defaultParallelism


def _measuring_scorer():
    return lambda texts: [json.dumps({"msg": "成功", "data": [{str(sum(map(len, texts))): 1}]}) for _ in texts]


def test_batches_of_texts_are_bounded_by_bytes(spark):
    posts = spark.range(0, 600, 1, 1).select("id", F.repeat(F.lit("word "), 4000).alias("post_content"))  # 12 MB in one task
    sizes = {int(r.sub_industry_id[0]) for r in E.classify(posts, _measuring_scorer).collect()}
    assert max(sizes) <= 3 << 20
