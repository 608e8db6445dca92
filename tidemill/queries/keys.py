"""Keys, cell encoding and request tables."""

from pyspark.sql import functions as F

from tidemill.functions import keys as K
from tidemill.operators import cells as C
from tidemill.operators.requests import translation_requests
from tidemill.operators.evaluate import spread
from tidemill.queries.registry import query, table

URL = "http://translate.example.com/api"

# the form encoder writes a space as +, encodes ~ and keeps *
FORM_SQL = "replace(replace(replace(url_encode({0}), '%20', '+'), '~', '%7E'), '%2A', '*')"

GROUPS_SQL = " || ".join(
    f"lower(to_base(concat('0x', substr(h, {start}, 5))::BIGINT, 32, 4))" for start in range(1, 36, 5)
)


@query(
    "row_keys",
    f"""SELECT c_custkey, ltrim({GROUPS_SQL}, '0') AS rowkey
FROM (SELECT c_custkey, lpad(md5(c_name), 35, '0') AS h FROM customer)""",
)
def row_keys(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", K.row_key("c_name").alias("rowkey"))


@query("md5_keys", "SELECT doc_id, md5(text) AS digest FROM documents")
def md5_keys(spark, sf):
    return table(spark, sf, "documents").select("doc_id", K.md5_hex("text").alias("digest"))


@query(
    "form_encode",
    f"""SELECT page_id, {FORM_SQL.format('url')} AS url, {FORM_SQL.format('html')} AS html FROM pages""",
)
def form_encode(spark, sf):
    pages = spread(table(spark, sf, "pages"))
    return pages.select("page_id", K.form_encode("url").alias("url"), K.form_encode("html").alias("html"))


@query(
    "query_strings",
    f"""SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END
|| CASE WHEN page_id % 3 = 0 THEN '' ELSE 'id=' || page_id || '&' END
|| 'html=' || {FORM_SQL.format('html')} AS request FROM pages""",
)
def query_strings(spark, sf):
    parameters = {
        "id": F.when(F.col("page_id") % 3 != 0, F.col("page_id").cast("string")),
        "html": F.col("html"),
    }
    pages = spread(table(spark, sf, "pages"))
    return pages.select("page_id", K.append_query("url", parameters).alias("request"))


@query(
    "translation_requests",
    f"""SELECT doc_id, sign, '{URL}?q=' || {FORM_SQL.format('text')} || '&from=' || lang
|| '&to=en&appid=app-1&salt=' || (1700000000000 + doc_id) || '&sign=' || sign AS request_url
FROM (SELECT *, md5('app-1' || text || (1700000000000 + doc_id) || 'not-a-secret') AS sign FROM documents)""",
)
def requests(spark, sf):
    docs = spread(table(spark, sf, "documents")).select(
        "doc_id", "text", "lang", (F.lit(1_700_000_000_000) + F.col("doc_id")).alias("salt")
    )
    signed = translation_requests(
        docs, URL, "app-1", "not-a-secret", "text", "lang", F.lit("en"), "salt"
    )
    return signed.select("doc_id", "sign", "request_url")


CELL_TYPES = {"c_name": "string", "cents": "int", "large": "long"}
CELL_INPUT_SQL = """SELECT c_custkey::VARCHAR AS rowkey, c_name,
round(c_acctbal * 100)::INTEGER AS cents, round(c_acctbal * 100)::BIGINT * 123456789 AS large FROM customer"""


def _typed_customers(spark, sf):
    cents = F.round(F.col("c_acctbal") * 100)
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("rowkey"),
        "c_name",
        cents.cast("int").alias("cents"),
        (cents.cast("long") * 123456789).alias("large"),
    )


@query(
    "encode_cells",
    f"""WITH i AS ({CELL_INPUT_SQL})
SELECT rowkey, 'info' AS family, 'c_name' AS qualifier, hex(c_name) AS value FROM i
UNION ALL SELECT rowkey, 'info', 'cents', right(lpad(to_hex(cents::BIGINT), 16, '0'), 8) FROM i
UNION ALL SELECT rowkey, 'info', 'large', lpad(to_hex(large), 16, '0') FROM i""",
)
def encode_cells(spark, sf):
    cells = C.encode_cells(_typed_customers(spark, sf), CELL_TYPES)
    return cells.select("rowkey", "family", "qualifier", F.hex("value").alias("value"))


@query("decode_cells", CELL_INPUT_SQL)
def decode_cells(spark, sf):
    return C.decode_cells(C.encode_cells(_typed_customers(spark, sf), CELL_TYPES), CELL_TYPES)
