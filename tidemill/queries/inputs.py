"""Inputs derived from the given tables, each in Spark and in SQL.

The tables hold few of the things the cleaning rules remove, so texts get a
decoration before and after, chosen by their number.  No row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.cells import to_cells
from tidemill.operators.evaluate import spread
from tidemill.queries.registry import table
from tidemill.queries.sqltext import quote

DECORATIONS = [
    ("", ""),
    ("#sale ", " https://a.example/c http://b.example/d"),
    ("Call Tel. 813-445-4818, or Tel:99-1 now. ", " tel. 5"),
    ("Email Address: a@b.example ", " Email Address:c@d.example and e@f.example"),
    ("中文\U0001f600 ok ", " ©\U0001f1e8\U0001f1f3 ✔️done"),
    ("1️⃣ first 2 ", " café かな \U0001fa70"),
    ("Go to www.shop.example.com.cn now. ", " see www shop.com today. Bye"),
    (" A , B,, C . . D,. ", " ,end , . .. ..."),
    ("\\ufe0f380White board \\u2714x ", " a�b  c   d"),
    ("# ", "\nwww.only.example.com"),
    ("\t. ,", " .\r\n"),
]


def decorated(spark_text: str, number: Column) -> Column:
    text = F.col(spark_text)
    choice = F.pmod(number, F.lit(len(DECORATIONS)))
    result = text
    for i, (before, after) in enumerate(DECORATIONS):
        result = F.when(choice == i, F.concat(F.lit(before), text, F.lit(after))).otherwise(result)
    return result


def decorated_sql(text: str, number: str) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {quote(before)} || {text} || {quote(after)}"
        for i, (before, after) in enumerate(DECORATIONS)
    )
    return f"CASE ({number}) % {len(DECORATIONS)} {cases} END"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id", decorated("text", F.col("doc_id")).alias("t"), "lang", "source"
    )


DOCUMENTS_SQL = (
    f"SELECT doc_id, {decorated_sql('text', 'doc_id')} AS t, lang, source FROM documents"
)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("conv_id") * 7 + F.col("turn")
    return spread(table(spark, sf_dir, "conversations")).select(
        "conv_id", "turn", "role", decorated("text", number).alias("t")
    )


CONVERSATIONS_SQL = (
    f"SELECT conv_id, turn, role, {decorated_sql('text', 'conv_id * 7 + turn')} AS t "
    "FROM conversations"
)

# -- messages: events as timed records of a topic log --------------------------


def epoch_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def _record_json() -> Column:
    age = F.when(F.col("event_id") % 11 == 0, '"x"').otherwise((F.col("user_id") % 90).cast("string"))
    return F.concat(
        F.lit('{"name":"u'), F.col("user_id").cast("string"),
        F.lit('","age":'), age,
        F.lit(',"time":"'), F.date_format("ts", "yyyy-MM-dd"),
        F.lit('","timestamp":'), F.floor(epoch_ms() / 1000).cast("string"),
        F.lit("}"),
    )


def messages(spark_events: DataFrame) -> DataFrame:
    """Topic log of an events frame (batch or stream): the offset is the event
    number, which grows within each partition as offsets do.  Some values are
    damaged."""
    record = _record_json()
    value = (
        F.when(F.col("event_id") % 8 == 1, "plain text")
        .when(F.col("event_id") % 8 == 2, F.concat(F.lit("["), record, F.lit("]")))
        .when(F.col("event_id") % 8 == 3, F.substring(record, 1, 20))
        .when(F.col("event_id") % 40 == 4, "")
        .when(F.col("event_id") % 40 == 12, "null")
        .when(F.col("event_id") % 40 == 20, F.concat(record, F.lit(" x")))
        .otherwise(record)
    )
    return spark_events.select(
        F.col("event_type").alias("topic"),
        value.alias("value"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


MESSAGES_SQL = """SELECT event_type AS topic, CASE
WHEN event_id % 8 = 1 THEN 'plain text'
WHEN event_id % 8 = 2 THEN '[' || r || ']'
WHEN event_id % 8 = 3 THEN substr(r, 1, 20)
WHEN event_id % 40 = 4 THEN ''
WHEN event_id % 40 = 12 THEN 'null'
WHEN event_id % 40 = 20 THEN r || ' x'
ELSE r END AS value,
(user_id % 3)::INTEGER AS partition, event_id AS "offset", epoch_us(ts) // 1000 AS ms
FROM (SELECT *, '{"name":"u' || user_id || '","age":'
|| CASE WHEN event_id % 11 = 0 THEN '"x"' ELSE (user_id % 90)::VARCHAR END
|| ',"time":"' || strftime(ts, '%Y-%m-%d')
|| '","timestamp":' || (epoch_us(ts) // 1000000) || '}' AS r FROM events)"""

IS_OBJECT_SQL = "(CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END)"

# -- posts as JSON messages -----------------------------------------------------


def post_messages(conversations_frame: DataFrame) -> DataFrame:
    """Conversation turns as post messages; some are cut short, some lack
    fields."""
    number = F.col("conv_id") * 7 + F.col("turn")
    record = F.to_json(
        F.struct(
            F.concat_ws("-", "conv_id", "turn").alias("rowkey"),
            F.col("turn").cast("string").alias("type"),
            F.when(number % 5 != 0, F.col("role")).alias("post_user_name"),
            F.col("t").alias("post_content"),
            F.lit("chat").alias("media"),
            F.lit(1).alias("unused"),
        )
    )
    value = (
        F.when(number % 9 == 0, F.expr("left(record, length(record) - 3)"))
        .when(number % 9 == 1, F.concat(F.lit("["), F.col("record"), F.lit("]")))
        .otherwise(F.col("record"))
    )
    return (
        conversations_frame.withColumn("record", record)
        .select(
            F.lit("posts").alias("topic"),
            value.alias("value"),
            (F.col("conv_id") % 3).cast("int").alias("partition"),
            (F.col("conv_id") * 1000 + F.col("turn")).alias("offset"),
        )
    )


GOOD_POSTS_SQL = f"""SELECT conv_id || '-' || turn AS rowkey, turn::VARCHAR AS type,
CASE WHEN (conv_id * 7 + turn) % 5 <> 0 THEN role END AS post_user_name, t,
NULL::VARCHAR AS dw_gofish_media_id, 'chat' AS media, 'posts' AS topic,
(conv_id % 3)::INTEGER AS partition, conv_id * 1000 + turn AS "offset"
FROM ({CONVERSATIONS_SQL}) WHERE (conv_id * 7 + turn) % 9 NOT IN (0, 1)"""

# -- dimension and ids ------------------------------------------------------------


def nation_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("rowkey"), F.col("n_regionkey").alias("parent_id"), "n_name"
    )
    return to_cells(nation.withColumn("rowkey", F.col("rowkey").cast("string")))


def word_ids(text: str) -> Column:
    """Ids of a text: the distinct word lengths modulo 30 (25 to 29 have no
    entry in the dimension)."""
    lengths = F.transform(F.split(text, " "), lambda w: (F.length(w) % 30).cast("string"))
    return F.array_distinct(lengths)


def word_ids_sql(text: str) -> str:
    return (
        f"list_distinct(list_transform(string_split({text}, ' '), "
        "lambda w: (length(w) % 30)::VARCHAR))"
    )


def ids_text_sql(ids: str) -> str:
    return f"coalesce(array_to_string(list_sort({ids}), ','), '')"


# parents of a list of ids, as the sorted distinct comma string
def parents_sql(ids: str) -> str:
    return (
        "coalesce((SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT DISTINCT "
        f"n_regionkey::VARCHAR AS p FROM nation WHERE list_contains({ids}, n_nationkey::VARCHAR))), '')"
    )
