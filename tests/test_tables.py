import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import cells as C
from tidemill.operators import documents as X
from tidemill.operators import evaluate
from tidemill.operators import messages as M
from tidemill.plans.seeding import publish, seed_messages
from tidemill.session import shared_dir


@pytest.fixture(params=["broadcast", "shuffle"])
def sizes(request, monkeypatch):
    """Both ways of every operator that measures a side before broadcasting."""
    if request.param == "shuffle":
        monkeypatch.setattr(evaluate, "MAX_BROADCAST_ROWS", 0)
        monkeypatch.setattr(evaluate, "MAX_BROADCAST_BYTES", 0)
    return request.param


CELLS = "rowkey string, family string, qualifier string, version long, value string"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def random_cells(spark, n=3000, seed=1):
    """Half of all cells belong to one row."""
    rnd = random.Random(seed)
    data = [
        (
            "hot" if rnd.random() < 0.5 else f"r{rnd.randint(0, 200)}",
            rnd.choice(["info", "meta"]),
            rnd.choice("abcd"),
            rnd.randint(0, 5),
            rnd.choice("uvwxyz"),
        )
        for _ in range(n)
    ]
    return data, spark.createDataFrame(data, CELLS).repartition(6)


def test_latest_and_projection(spark):
    data, frame = random_cells(spark)
    newest = {}
    for r, f, q, v, x in data:
        newest[r, f, q] = max(newest.get((r, f, q), (-1, "")), (v, x))
    assert rows(C.latest_cells(frame)) == sorted(((*k, *v) for k, v in newest.items()), key=repr)
    expected = {r: tuple(newest.get((r, "info", q), (0, None))[1] for q in "abz") for r, _, _ in newest}
    got = {r.rowkey: tuple(r)[1:] for r in C.project_cells(frame, ["a", "b", "z"]).collect()}
    assert got == expected
    filled = {r: v for r, v in expected.items() if any(v)}
    got = C.project_cells(frame, ["a", "b", "z"], empty_rows=False).collect()
    assert {r.rowkey: tuple(r)[1:] for r in got} == filled


def test_point_gets(spark, sizes):
    data, frame = random_cells(spark)
    keys = spark.createDataFrame([("hot",), ("r1",), ("unknown",), ("r1",)], "rowkey string")
    for family in (None, "info"):
        newest = {}
        for r, f, q, v, x in data:
            if family in (None, f):
                newest[r, q] = max(newest.get((r, q), (-1,)), (v, f, x))
        got = {r.rowkey: r.cells for r in C.get_rows(frame, keys, family).collect()}
        assert got == {
            k: {q: v[2] for (r, q), v in newest.items() if r == k} for k in ("hot", "r1", "unknown")
        }


def test_documents_to_cells(spark):
    frame = spark.createDataFrame([("k", "a", None), ("l", None, 5)], "rowkey string, s string, n int")
    assert rows(C.to_cells(frame, version=3)) == [
        ("k", "info", "s", 3, "a"), ("l", "info", "n", 3, "5"),
    ]


def test_record_cells(spark):
    messages = spark.createDataFrame(
        [
            ("topic1", '{"name":"alice","age":3,"time":"t"}', 1),
            ("topic1", '{"name":"alice","age":4}', 2),
            ("topic2", '{"name":"bob"}', 3),
            ("topic1", "broken", 4),
        ],
        "topic string, value string, offset long",
    )
    cells = C.record_cells(messages, {"topic1": "base:t1"}, order=F.col("offset"))
    key = "33gjhb462bpfqotj7h1ijqclhs"
    assert rows(cells) == [
        ("base:t1", key, "info", "adid", 0, "alice"),
        ("base:t1", key, "info", "adname", 0, "4"),
    ]


def test_time_keys_do_not_collide(spark):
    frame = spark.range(1000).select(F.col("id").cast("int").alias("n"))
    cells = C.time_keyed_cells(frame, {"n": "int"}, F.lit(1_600_000_000_000))
    assert cells.select("rowkey").distinct().count() == 1000
    assert {r.version for r in cells.collect()} == {1_600_000_000_000}


DOCS = "meta_id string, a string, b string"


def test_upsert_with_a_hot_id(spark, sizes):
    current = spark.createDataFrame([("1", "x", "y"), ("2", "x", "y")], DOCS)
    delta = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, "2").otherwise((F.col("id") % 5 + 1).cast("string")).alias("meta_id"),
        F.col("id").cast("string").alias("a"),
        F.lit(None).cast("string").alias("b"),
        F.col("id").alias("seq"),
    )
    got = rows(X.upsert(current, delta, ["meta_id"], F.col("seq")))
    last = {}
    for i in range(2000):
        last["2" if i % 2 == 0 else str(i % 5 + 1)] = str(i)
    last.setdefault("1", "x")
    assert got == sorted((k, v, None if v != "x" else "y") for k, v in last.items())


def test_partial_update(spark, sizes):
    current = spark.createDataFrame([("1", "x", "y"), ("2", "x", "y")], DOCS)
    delta = spark.createDataFrame([("2", None), ("3", "new")], "meta_id string, b string")
    merged = X.merge_supplied(current, delta, ["meta_id"])
    assert rows(merged) == [("1", "x", "y"), ("2", "x", None), ("3", None, "new")]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert ("FullOuter" in plan) == (sizes == "shuffle")
    wider = delta.withColumn("c", F.lit(1))
    got = X.merge_supplied(current, wider, ["meta_id"]).select("meta_id", "a", "b", "c")
    assert rows(got) == [("1", "x", "y", None), ("2", "x", None, 1), ("3", None, "new", 1)]


def test_size_check(spark, monkeypatch):
    assert evaluate.is_small(spark.range(10))
    monkeypatch.setattr(evaluate, "MAX_BROADCAST_ROWS", 9)
    assert not evaluate.is_small(spark.range(10))
    monkeypatch.setattr(evaluate, "MAX_BROADCAST_ROWS", 10)
    monkeypatch.setattr(evaluate, "MAX_BROADCAST_BYTES", 50)
    assert not evaluate.is_small(spark.range(10))


def documents(spark, times):
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(times)], "id string, update_time string")
    meta = F.create_map(F.lit("_index"), F.lit("ix"), F.lit("_id"), F.col("id"), F.lit("_score"), F.lit("1.0"))
    return frame.select(meta.alias("_metadata"), "update_time")


def test_document_scans(spark):
    docs = documents(spark, ["2021-03", None, "2021-01", "2021-02"])
    assert [r.meta_id for r in X.scan_updates(docs).collect()] == ["1", "2", "3", "0"]
    assert X.scan_documents(docs).columns == ["meta_index", "meta_id", "meta_score"]
    assert X.high_water_mark(docs).first()[0] == "2021-03"
    mark = X.high_water_mark(documents(spark, ["2021-01"]))
    assert rows(X.scan_documents(X.changed_since(docs, mark)).select("meta_id")) == [("0",), ("3",)]
    assert [r.meta_id for r in X.preview(X.scan_documents(docs, "update_time"), ["update_time"], 2).collect()] == ["1", "2"]


def test_stringified_rows_get_distinct_ids(spark):
    frame = X.stringify(spark.range(100))
    assert dict(frame.dtypes) == {"meta_id": "string", "id": "string"}
    assert frame.select("meta_id").distinct().count() == 100


def test_message_shapes(spark):
    frame = spark.createDataFrame([("t1", "né", None)], "topic string, value string, n int")
    assert tuple(M.to_topic(frame, "out", ["value", "n"]).first()) == ("out", '{"value":"né"}')
    row = M.to_row_topics(frame).first()
    assert (row.topic, row.key, bytes(row.value)) == ("t1", None, "né".encode())
    assert tuple(M.to_hash(frame, "h", "topic", "value").first()) == ("h", "t1", "né")


def test_routes_and_positions(spark, sizes):
    log = spark.createDataFrame(
        [("a", 0, 0), ("a", 0, 5), ("a", 1, 7), ("b", 0, 2), ("c", 0, 9)],
        "topic string, partition int, offset long",
    )
    routed = M.route(log, {"side": ["a", "c"], "other": ["b"]})
    assert rows(routed.select("topic", "route").distinct()) == [("a", "side"), ("b", "other"), ("c", "side")]
    assert rows(M.end_positions(log)) == [("a", 0, 6), ("a", 1, 8), ("b", 0, 3), ("c", 0, 10)]
    start = spark.createDataFrame([("a", 0, 5), ("b", 0, 3)], "topic string, partition int, start_offset long")
    assert rows(M.from_offsets(log, start)) == [("a", 0, 5), ("a", 1, 7), ("c", 0, 9)]
    assert [tuple(r) for r in M.in_input_order(log.repartition(5)).collect()] == sorted(map(tuple, log.collect()))


def test_seeding_sends_every_row(spark):
    cells = spark.range(500).select(
        F.col("id").cast("string").alias("rowkey"), F.lit("info").alias("family"),
        F.lit("media").alias("qualifier"), F.lit(1).cast("long").alias("version"), F.lit("m").alias("value"),
    )
    target = shared_dir(spark, "published")
    publish(seed_messages(cells, "media_test"), "parquet", path=target)
    sent = spark.read.parquet(target)
    assert sent.count() == 500
    assert sent.filter(F.get_json_object("value", "$.media") == "m").count() == 500


def test_many_well_compressed_rows_are_not_small(spark, tmp_path):
    from pyspark.sql import functions as F

    for n, few in ((100_000, True), (100_001, False)):
        path = f"{tmp_path}/{n}"
        spark.range(n).select(F.lit("one key").alias("rowkey")).write.parquet(path)
        assert evaluate.sized(spark.read.parquet(path))[1] is few
