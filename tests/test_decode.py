import pytest
from pyspark.errors import PySparkException

from tidemill.functions import jsons
from tidemill.operators import decode as D


def values(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")


TEXTS = {
    '{"a":1}': True,
    "{}": True,
    '{"a":{"b":2}}': True,
    ' \n{"a":1}\t': True,
    "[1]": False,
    '[{"a":1}]': False,
    "1": False,
    "null": False,
    "x": False,
    '{"a":1': False,
    '{"a":1} x': False,
    '{"a":1}{"b":2}': False,
    '{"a":1},{"b":2}': False,
    "": False,
    None: False,
}


def test_json_object_predicate(spark):
    rows = values(spark, TEXTS).select("value", jsons.is_json_object("value").alias("x")).collect()
    assert {r.value: r.x for r in rows} == TEXTS


def test_posts_and_rejects_share_the_input(spark):
    frame = values(spark, TEXTS)
    decoded = D.decode_posts(frame)
    good, rejects = decoded.good.collect(), decoded.rejects.collect()
    assert {r.i for r in good} == {i for i, ok in enumerate(TEXTS.values()) if ok}
    assert {r.i for r in rejects} == {i for i, ok in enumerate(TEXTS.values()) if not ok}
    assert decoded.rejects.columns == frame.columns


def test_post_fields(spark):
    text = '{"rowkey":"r1","type":"1","post_content":"a \\"q\\" é","extra":[1],"media":null}'
    row = D.decode_posts(values(spark, [text])).good.first()
    assert (row.rowkey, row.type, row.post_content) == ("r1", "1", 'a "q" é')
    assert row.media is None and row.post_user_name is None


def test_timed_records(spark):
    texts = [
        '{"name":"a","age":31,"time":"t","timestamp":100}',
        '{"name":"b","age":"32"}',
        '{"name":"c","age":"x"}',
        '{"age":3000000000}',
        '{"timestamp":1.5}',
        "{}",
    ]
    decoded = D.decode_timed_records(values(spark, texts))
    assert [(r.i, r.name, r.age, r.timestamp) for r in decoded.good.orderBy("i").collect()] == [
        (0, "a", 31, 100), (1, "b", 32, None), (5, None, None, None),
    ]
    assert sorted(r.i for r in decoded.rejects.collect()) == [2, 3, 4]


def test_fail_fast(spark):
    spark.sparkContext.setLogLevel("OFF")
    with pytest.raises(PySparkException, match="malformed record"):
        D.decode_timed_records(values(spark, ["{}", "x"]), fail_fast=True).good.collect()
    spark.sparkContext.setLogLevel("ERROR")
    assert D.decode_timed_records(values(spark, ["{}"]), fail_fast=True).good.count() == 1


def test_replies(spark):
    texts = {
        '{"msg":"成功","data":[{"75":0.9,"36":0.1}]}': ["36", "75"],
        '{"msg":"成功","data":["{\\"75\\":0.9,\\"36\\":0.1}"]}': ["36", "75"],
        '{"msg":"成功","data":[{}]}': [],
        '{"msg":"no","data":[{"75":0.9}]}': None,
        "garbage": None,
        None: None,
    }
    rows = values(spark, texts).select("value", jsons.reply_industries("value").alias("x")).collect()
    assert {r.value: r.x for r in rows} == texts


def test_whitelist(spark):
    cases = [(["75", "x"], True), (["7"], False), (["0757"], False), ([], False), (None, False)]
    frame = spark.createDataFrame([(c[0],) for c in cases], "ids array<string>")
    assert [r[0] for r in frame.select(jsons.in_whitelist("ids")).collect()] == [c[1] for c in cases]


def test_json_leaves_out_nulls(spark):
    frame = spark.createDataFrame([(1, None)], "a int, b string")
    assert D.encode_rows(frame).first().value == '{"a":1}'


def test_envelope(spark):
    frame = spark.createDataFrame([("t", "né".encode(), 1, 2)], "topic string, value binary, partition int, offset long")
    assert tuple(D.decode_envelope(frame).first()) == ("t", "né", 1, 2)
