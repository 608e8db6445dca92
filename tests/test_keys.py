import hashlib
import urllib.parse

from pyspark.sql import functions as F

from tidemill.functions import codec, keys
from tidemill.operators.cells import decode_cells, encode_cells
from tidemill.operators.requests import translation_requests


def test_row_key(spark):
    known = {
        "alice": "33gjhb462bpfqotj7h1ijqclhs",
        "bob": "4vjl8ros7f4755o57j0uc0kaeo",
        "": "6k3m6dj3o0m82ej009j3mfggju",
        "é": "36rn6pfjuulepfdusaj6dknhrf",
        None: None,
    }
    rows = spark.createDataFrame([(k,) for k in known], "s string")
    assert {r.s: r.k for r in rows.select("s", keys.row_key("s").alias("k")).collect()} == known


def _base32(n):
    digits = ""
    while n:
        digits, n = "0123456789abcdefghijklmnopqrstuv"[n % 32] + digits, n // 32
    return digits


def test_row_key_against_big_integers(spark):
    rows = spark.range(3000).select(F.concat(F.lit("key-"), "id").alias("s"))
    for r in rows.select("s", keys.row_key("s").alias("k")).collect():
        assert r.k == _base32(int(hashlib.md5(r.s.encode()).hexdigest(), 16))


def test_form_encode(spark):
    texts = ["a b&c=d", "~*-._", "é中", "%", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in rows.select(keys.form_encode("s")).collect()]
    assert got == ["a+b%26c%3Dd", "%7E*-._", "%C3%A9%E4%B8%AD", "%25", "", ""]


def test_append_query_skips_null(spark):
    rows = spark.createDataFrame(
        [("http://h/p", "1", None), ("http://h/p?x=1", None, "a b"), ("http://h", None, None)],
        "u string, a string, b string",
    )
    got = [r[0] for r in rows.select(keys.append_query("u", {"a": "a", "b": "b"})).collect()]
    assert got == ["http://h/p?a=1", "http://h/p?x=1&b=a+b", "http://h?"]


def test_translation_requests(spark):
    rows = spark.createDataFrame([("grüß dich", 5)], "q string, salt long")
    row = translation_requests(rows, "http://t/x", "id", "key", "q", F.lit("de"), F.lit("en"), "salt").first()
    sign = hashlib.md5("idgrüß dich5key".encode()).hexdigest()
    assert row.sign == sign
    parts = urllib.parse.parse_qs(urllib.parse.urlparse(row.request_url).query)
    assert parts == {
        "q": ["grüß dich"], "from": ["de"], "to": ["en"], "appid": ["id"], "salt": ["5"], "sign": [sign],
    }
    assert "key" not in row.request_url


def test_integer_extremes(spark):
    ints = [0, 1, -1, 2**31 - 1, -(2**31), None]
    longs = [0, -1, 2**63 - 1, -(2**63), 255, None]
    rows = spark.createDataFrame(list(zip(ints, longs)), "i int, l long")
    coded = rows.select("*", codec.encode_int("i").alias("ib"), codec.encode_long("l").alias("lb"))
    for r in coded.select("*", codec.decode_int("ib").alias("i2"), codec.decode_long("lb").alias("l2")).collect():
        assert (r.i2, r.l2) == (r.i, r.l)
        assert r.ib is None if r.i is None else bytes(r.ib) == r.i.to_bytes(4, "big", signed=True)
        assert r.lb is None if r.l is None else bytes(r.lb) == r.l.to_bytes(8, "big", signed=True)


def test_cells_round_trip(spark):
    rows = spark.createDataFrame([("k1", "é", -5, None), ("k2", None, None, 7)], "rowkey string, s string, i int, l long")
    types = {"s": "string", "i": "int", "l": "long"}
    cells = encode_cells(rows, types)
    assert cells.count() == 3
    back = decode_cells(cells, types)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
