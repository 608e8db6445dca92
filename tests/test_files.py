from pyspark.sql import functions as F

from tidemill.session import shared_dir
from tidemill.sources import files


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_comma_records(spark):
    texts = ["ann,31,2021-01-26", "bob,-2,", "c,x,2021", "d,1", "e,3,t,extra", "", "f, 4,t", "g,9999999999,t", "h,+5,,x"]
    decoded = files.comma_records(lines(spark, texts))
    assert sorted(map(tuple, decoded.good.collect())) == [("ann", 31, "2021-01-26"), ("e", 3, "t"), ("h", 5, "")]
    assert {r.value for r in decoded.rejects.collect()} == {"bob,-2,", "c,x,2021", "d,1", "", "f, 4,t", "g,9999999999,t"}


def test_ampersand_posts(spark):
    texts = ['"Some User"&"3"&1614666023200&Text & more, with "quotes" \\u2757', '"u"&"4"&x&t', '"u"&"4"&1', '"u"&"5"&0&']
    decoded = files.ampersand_posts(lines(spark, texts))
    rows = decoded.good.withColumn("event_time", F.unix_millis("event_time")).collect()
    assert [tuple(r) for r in rows] == [
        ("Some User", "3", 1614666023200, 'Text & more, with "quotes" \\u2757'),
        ("u", "5", 0, ""),
    ]
    assert decoded.rejects.count() == 2


def test_csv(spark):
    base = shared_dir(spark, "csv")
    lines(spark, ["id,name,when", " 1 , é x ,2021", "2,,"]).coalesce(1).write.text(f"{base}/t")
    frame = files.read_csv(spark, base, "t")
    assert dict(frame.dtypes) == {"id": "int", "name": "string", "when": "int"}
    assert sorted(map(tuple, frame.collect())) == [(1, "é x", 2021), (2, None, None)]
    typed = files.read_csv(spark, base, "t", "id long, name string, when string")
    assert dict(typed.dtypes) == {"id": "bigint", "name": "string", "when": "string"}


def test_orc_paths(spark):
    base = shared_dir(spark, "orc")
    spark.range(3).write.orc(f"{base}/test_data/t")
    spark.range(5).write.orc(f"{base}/other/t")
    assert files.read_orc(spark, base, "t").count() == 3
    assert files.read_orc(spark, base, "t", "other").count() == 5
