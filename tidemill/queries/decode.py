"""Message decoding."""

from pyspark.sql import functions as F

from tidemill.functions import jsons
from tidemill.operators import decode as D
from tidemill.operators.evaluate import spread
from tidemill.queries import inputs
from tidemill.queries.inputs import IS_OBJECT_SQL, MESSAGES_SQL
from tidemill.queries.registry import query, table

AGE_SQL = "json_extract_string(value, '$.age')"


def _messages(spark, sf):
    return inputs.messages(spread(table(spark, sf, "events")))


@query(
    "decode_posts",
    f"SELECT * RENAME (t AS post_content) FROM ({inputs.GOOD_POSTS_SQL})",
)
def decode_posts(spark, sf):
    return D.decode_posts(inputs.post_messages(inputs.conversations(spark, sf))).good


@query(
    "rejected_posts",
    f"""SELECT (conv_id % 3)::INTEGER AS partition, conv_id * 1000 + turn AS "offset"
FROM ({inputs.CONVERSATIONS_SQL}) WHERE (conv_id * 7 + turn) % 9 IN (0, 1)""",
)
def rejected_posts(spark, sf):
    rejects = D.decode_posts(inputs.post_messages(inputs.conversations(spark, sf))).rejects
    return rejects.select("partition", "offset")


TIMED_SQL = f"""SELECT *, CASE WHEN {IS_OBJECT_SQL} THEN TRY_CAST({AGE_SQL} AS INTEGER) IS NOT NULL
ELSE false END AS ok FROM ({MESSAGES_SQL})"""


@query(
    "decode_timed_records",
    f"""SELECT topic, partition, "offset", json_extract_string(value, '$.name') AS name,
TRY_CAST({AGE_SQL} AS INTEGER) AS age, json_extract_string(value, '$.time') AS time,
json_extract(value, '$.timestamp')::BIGINT AS timestamp FROM ({TIMED_SQL}) WHERE ok""",
)
def decode_timed(spark, sf):
    return D.decode_timed_records(_messages(spark, sf)).good


@query("rejected_timed_records", f'SELECT topic, partition, "offset", value FROM ({TIMED_SQL}) WHERE NOT ok')
def rejected_timed(spark, sf):
    rejects = D.decode_timed_records(_messages(spark, sf)).rejects
    return rejects.select("topic", "partition", "offset", "value")


@query("json_objects", f'SELECT "offset", {IS_OBJECT_SQL} AS is_object FROM ({MESSAGES_SQL})')
def json_objects(spark, sf):
    messages = _messages(spark, sf)
    return messages.select("offset", jsons.is_json_object("value").alias("is_object"))


@query("decode_envelopes", "SELECT lang AS topic, text AS value, doc_id AS \"offset\" FROM documents")
def decode_envelopes(spark, sf):
    raw = table(spark, sf, "documents").select(
        F.col("lang").alias("topic"),
        F.encode("text", "UTF-8").alias("value"),
        F.col("doc_id").alias("offset"),
    )
    return D.decode_envelope(raw)


@query(
    "classifier_replies",
    f"""SELECT doc_id, doc_id % 5 <> 0 AS ok,
CASE WHEN doc_id % 5 <> 0 THEN CASE WHEN doc_id % 7 = 0 THEN ''
ELSE {inputs.ids_text_sql(inputs.word_ids_sql('text'))} END END AS ids FROM documents""",
)
def classifier_replies(spark, sf):
    """Replies as an object, as a string holding one, empty, and failed."""
    scores = F.to_json(
        F.map_from_entries(
            F.transform(inputs.word_ids("text"), lambda i: F.struct(i, F.lit(0.5).alias("p")))
        )
    )
    scores = F.when(F.col("doc_id") % 7 == 0, "{}").otherwise(scores)
    message = F.when(F.col("doc_id") % 5 != 0, "成功").otherwise("失败")
    as_object = F.concat(F.lit('{"msg":"'), message, F.lit('","data":['), scores, F.lit("]}"))
    as_text = F.to_json(F.struct(message.alias("msg"), F.array(scores).alias("data")))
    reply = F.when(F.col("doc_id") % 2 == 0, as_text).otherwise(as_object)
    replies = spread(table(spark, sf, "documents")).select("doc_id", reply.alias("reply"))
    return replies.select(
        "doc_id",
        jsons.reply_ok("reply").alias("ok"),
        F.array_join(jsons.reply_industries("reply"), ",").alias("ids"),
    )


@query(
    "industry_fields",
    """SELECT o_orderkey, concat_ws(',', o_custkey % 30,
CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 30 END, length(o_orderpriority)) AS ids FROM orders""",
)
def industry_fields(spark, sf):
    return _industry_messages(spark, sf).select(
        "o_orderkey",
        F.array_join(
            jsons.json_strings("value", ("industry_1", "industry_2", "industry_3")), ","
        ).alias("ids"),
    )


def _industry_messages(spark, sf):
    fields = F.struct(
        (F.col("o_custkey") % 30).cast("string").alias("industry_1"),
        F.when(F.col("o_orderstatus") == "F", (F.col("o_orderkey") % 30).cast("string")).alias("industry_2"),
        F.length("o_orderpriority").cast("string").alias("industry_3"),
    )
    return spread(table(spark, sf, "orders")).select("o_orderkey", F.to_json(fields).alias("value"))


@query(
    "rows_to_json",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 3 END AS fields,
(o_custkey % 30)::VARCHAR AS first_field FROM orders""",
)
def rows_to_json(spark, sf):
    """NULL fields are left out of the JSON text."""
    orders = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 30).cast("string").alias("industry_1"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"),
        "o_orderkey",
    )
    rows = D.encode_rows(orders)
    return rows.select(
        F.get_json_object("value", "$.o_orderkey").cast("long").alias("o_orderkey"),
        F.size(F.json_object_keys("value")).alias("fields"),
        F.get_json_object("value", "$.industry_1").alias("first_field"),
    )
