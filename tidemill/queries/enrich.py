"""Classification, parent lookup and the whole enrichment flow."""

import json

from pyspark.sql import functions as F

from tidemill.functions.jsons import join_ids
from tidemill.operators import clean
from tidemill.operators import enrich as E
from tidemill.operators.evaluate import spread
from tidemill.operators.messages import in_input_order
from tidemill.plans.enrichment import enrich_messages, enrich_posts
from tidemill.plans.router import route_messages
from tidemill.queries import inputs
from tidemill.queries import sqltext as S
from tidemill.queries.decode import _industry_messages
from tidemill.queries.registry import query, table
from tidemill.session import shared_dir


def stand_in_scorer():
    """A model without a service: the ids of a text are its distinct word
    lengths modulo 30.  It never answers for texts whose length divides by 7."""

    def score(texts):
        return [_reply(text) for text in texts]

    return score


def _reply(text):
    if len(text) % 7 == 0:
        return json.dumps({"msg": "失败"})
    ids = {str(len(word) % 30): 0.5 for word in text.split(" ")}
    return json.dumps({"msg": "成功", "data": [ids]}, ensure_ascii=False)


def dimension(spark, sf):
    return E.industry_dimension(inputs.nation_cells(spark, sf))


IDS = inputs.word_ids_sql("t")
IDS_TEXT = inputs.ids_text_sql(IDS)


@query(
    "classify_posts",
    f"""SELECT doc_id, CASE WHEN length(text) % 7 <> 0 THEN
{inputs.ids_text_sql(inputs.word_ids_sql('text'))} END AS ids,
CASE WHEN length(text) % 7 = 0 THEN 3 ELSE 1 END AS attempts,
CASE WHEN length(text) % 7 = 0 THEN 'failed' ELSE 'ok' END AS classify_status FROM documents""",
)
def classify_posts(spark, sf):
    docs = spread(table(spark, sf, "documents")).select(
        "doc_id", F.col("text").alias("post_content")
    )
    scored = E.classify(docs, stand_in_scorer)
    return scored.select(
        "doc_id",
        F.array_join("sub_industry_id", ",").alias("ids"),
        "attempts",
        "classify_status",
    )


def hanging_scorer():
    """The stand-in model over a line that hangs for texts whose length divides by 49."""
    import time

    def score(texts):
        if any(len(text) % 49 == 0 for text in texts):
            time.sleep(4)
        return ['{"msg":"成功","data":[{}]}' for _ in texts]

    return score


@query(
    "classify_deadline",
    """SELECT doc_id, 1 AS attempts, CASE WHEN length(text) % 49 = 0 THEN 'timeout' ELSE 'ok' END AS classify_status,
CASE WHEN length(text) % 49 = 0 THEN 'timeout' END AS classify_error FROM documents""",
)
def classify_deadline(spark, sf):
    """Calls that hang cost their texts, and no other text waits for them."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("post_content"))
    scored = E.classify(docs, hanging_scorer, max_attempts=1, deadline_seconds=2.0, in_flight=10, call_texts=1)
    return scored.select("doc_id", "attempts", "classify_status", "classify_error")


@query(
    "classify_distinct",
    f"""SELECT doc_id, CASE WHEN length(text) % 7 <> 0 THEN
{inputs.ids_text_sql(inputs.word_ids_sql('text'))} END AS ids,
CASE WHEN length(text) % 7 = 0 THEN 3 WHEN doc_id % 2 = 0 OR text IN (SELECT text FROM documents WHERE doc_id % 2 = 0)
THEN 0 ELSE 1 END AS attempts,
CASE WHEN length(text) % 7 = 0 THEN 'failed' ELSE 'ok' END AS classify_status FROM documents""",
)
def classify_distinct(spark, sf):
    """Each distinct text is sent once.  The even documents were sent by an earlier run: their texts, and those of their
    copies, are not sent again unless the model did not answer."""
    docs = spread(table(spark, sf, "documents")).select("doc_id", F.col("text").alias("post_content"))
    replies = E.Replies(shared_dir(spark, "replies"))
    E.classify_distinct(docs.where("doc_id % 2 = 0"), stand_in_scorer, replies)
    scored = E.classify_distinct(docs, stand_in_scorer, replies)
    return scored.select("doc_id", F.array_join("sub_industry_id", ",").alias("ids"), "attempts", "classify_status")


LOOKUP_SQL = f"""WITH i AS (SELECT doc_id, {inputs.word_ids_sql('text')} AS ids FROM documents),
p AS (SELECT doc_id, {inputs.ids_text_sql('ids')} AS sub_industry_id, {inputs.parents_sql('ids')} AS parent_id FROM i)
SELECT *, CASE WHEN sub_industry_id = '' OR parent_id <> '' THEN 'ok' ELSE 'unmatched' END AS enrich_status FROM p"""


def _documents_with_ids(spark, sf):
    return spread(table(spark, sf, "documents")).select(
        "doc_id", inputs.word_ids("text").alias("sub_industry_id")
    )


@query("lookup_parents", LOOKUP_SQL)
def lookup_parents(spark, sf):
    return E.lookup_parents(_documents_with_ids(spark, sf), dimension(spark, sf), ["doc_id"])


@query("lookup_parents_join", LOOKUP_SQL)
def lookup_parents_join(spark, sf):
    """The form for dimensions of any size."""
    return E.lookup_parents(
        _documents_with_ids(spark, sf), dimension(spark, sf), ["doc_id"], strategy="join"
    )


KEYED_FORMS_SQL = f"""WITH i AS (SELECT {{key}} AS key, doc_id, doc_id % 7 AS _row, {inputs.word_ids_sql('text')} AS ids FROM documents)
SELECT form, key, doc_id, _row, {inputs.parents_sql('ids')} AS parent_id FROM i, (VALUES ('inline'), ('join')) AS f(form)"""


def _keyed_forms(spark, sf, key):
    """Both forms over posts of a key, with a column whose name the library might use itself."""
    posts = spread(table(spark, sf, "documents")).select(
        key.alias("key"), "doc_id", (F.col("doc_id") % 7).alias("_row"), inputs.word_ids("text").alias("sub_industry_id")
    )
    found = [
        E.lookup_parents(posts, dimension(spark, sf), ["key"], strategy=form).select(
            F.lit(form).alias("form"), "key", "doc_id", "_row", "parent_id"
        )
        for form in ("inline", "join")
    ]
    return found[0].unionByName(found[1])


@query("lookup_duplicate_keys", KEYED_FORMS_SQL.format(key="lang"))
def lookup_duplicate_keys(spark, sf):
    """Posts of one key are posts of their own."""
    return _keyed_forms(spark, sf, F.col("lang"))


@query("lookup_null_keys", KEYED_FORMS_SQL.format(key="CASE WHEN doc_id % 2 = 0 THEN source END"))
def lookup_null_keys(spark, sf):
    return _keyed_forms(spark, sf, F.when(F.col("doc_id") % 2 == 0, F.col("source")))


@query(
    "lookup_by_customer",
    """WITH p AS (SELECT c.o_orderkey, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS parent_id
FROM (SELECT o_orderkey, unnest([o_custkey, o_custkey + 1, o_custkey + 100000000]) AS id FROM orders) c
JOIN customer ON c_custkey = id JOIN nation ON n_nationkey = c_nationkey GROUP BY 1)
SELECT o_orderkey, array_to_string(list_sort([o_custkey::VARCHAR, (o_custkey + 1)::VARCHAR,
(o_custkey + 100000000)::VARCHAR]), ',') AS sub_industry_id, coalesce(parent_id, '') AS parent_id,
CASE WHEN parent_id IS NULL THEN 'unmatched' ELSE 'ok' END AS enrich_status FROM orders LEFT JOIN p USING (o_orderkey)""",
)
def lookup_by_customer(spark, sf):
    """A dimension that grows with the data (customer to nation)."""
    ids = [F.col("o_custkey"), F.col("o_custkey") + 1, F.col("o_custkey") + 100000000]
    posts = spread(table(spark, sf, "orders")).select(
        "o_orderkey", F.array(*[i.cast("string") for i in ids]).alias("sub_industry_id")
    )
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("parent_id"))
    by_customer = customers.join(nations, "n_nationkey").select("id", "parent_id")
    return E.lookup_parents(posts, by_customer, ["o_orderkey"])


ORDER_IDS_SQL = """[(o_custkey % 30)::VARCHAR, CASE WHEN o_orderstatus = 'F' THEN (o_orderkey % 30)::VARCHAR END,
length(o_orderpriority)::VARCHAR]"""


@query(
    "lookup_from_json",
    f"""SELECT o_orderkey, {inputs.parents_sql('ids')} AS parent_id
FROM (SELECT o_orderkey, {ORDER_IDS_SQL} AS ids FROM orders)""",
)
def lookup_from_json(spark, sf):
    found = E.lookup_from_json(_industry_messages(spark, sf), dimension(spark, sf), ["o_orderkey"])
    return found.select("o_orderkey", F.get_json_object("value", "$.parent_id").alias("parent_id"))


@query(
    "parent_sets",
    f"""SELECT doc_id, CASE WHEN p = '' THEN 0 ELSE len(string_split(p, ',')) END AS n, p AS parents
FROM (SELECT doc_id, {inputs.parents_sql('ids')} AS p FROM
(SELECT doc_id, {inputs.word_ids_sql('text')} AS ids FROM documents))""",
)
def parent_sets(spark, sf):
    """Distinct parents accumulated per record."""
    found = E.lookup_parents(_documents_with_ids(spark, sf), dimension(spark, sf), ["doc_id"])
    n = F.when(F.col("parent_id") == "", 0).otherwise(F.size(F.split("parent_id", ",")))
    return found.select("doc_id", n.cast("long").alias("n"), F.col("parent_id").alias("parents"))


# -- the whole flow -----------------------------------------------------------------


def _enriched_sql(rows: str, columns: str, extra: str = "") -> str:
    """Result rows of cleaned posts ``rows`` with their text in ``t``."""
    return f"""SELECT {columns}, t AS post_content{extra},
CASE WHEN ok THEN {IDS_TEXT} ELSE '' END AS sub_industry_id,
CASE WHEN ok THEN {inputs.parents_sql(IDS)} ELSE '' END AS parent_id,
CASE WHEN NOT ok THEN 'failed' WHEN {inputs.parents_sql(IDS)} <> '' THEN 'ok' ELSE 'unmatched' END AS enrich_status
FROM (SELECT *, length(t) % 7 <> 0 AS ok FROM {rows} WHERE t <> '')"""


def document_posts(spark, sf):
    return clean.as_posts(
        inputs.documents(spark, sf),
        {"rowkey": "doc_id", "type": "lang", "post_user_name": "source", "post_content": "t", "media": F.lit("web")},
    )


ENRICH_DOCUMENTS_SQL = S.clean_chain(inputs.DOCUMENTS_SQL) + _enriched_sql(
    "cleaned",
    "doc_id::VARCHAR AS rowkey, lang AS type, source AS post_user_name, "
    "NULL::VARCHAR AS dw_gofish_media_id, 'web' AS media",
)


@query("enrich_documents", ENRICH_DOCUMENTS_SQL)
def enrich_documents(spark, sf):
    enriched = enrich_posts(
        document_posts(spark, sf), dimension(spark, sf), stand_in_scorer, ["rowkey"]
    )
    return clean.as_results(enriched, "enrich_status")


CLEANED_MESSAGES_SQL = S.clean_chain(inputs.GOOD_POSTS_SQL)
ENRICH_MESSAGES_SQL = CLEANED_MESSAGES_SQL + _enriched_sql(
    "cleaned", "rowkey, type, post_user_name, dw_gofish_media_id, media"
)


def post_messages(spark, sf):
    return inputs.post_messages(inputs.conversations(spark, sf))


@query("enrich_messages", ENRICH_MESSAGES_SQL)
def enrich_from_messages(spark, sf):
    enriched = enrich_messages(post_messages(spark, sf), dimension(spark, sf), stand_in_scorer)
    return clean.as_results(enriched, "enrich_status")


@query(
    "ordered_results",
    CLEANED_MESSAGES_SQL
    + f""" SELECT topic, partition, "offset", rowkey, CASE WHEN length(t) % 7 <> 0 THEN {IDS_TEXT} ELSE '' END AS ids
FROM cleaned WHERE t <> '' ORDER BY topic, partition, "offset" """,
)
def ordered_results(spark, sf):
    enriched = enrich_messages(post_messages(spark, sf), dimension(spark, sf), stand_in_scorer)
    ordered = in_input_order(enriched)
    return ordered.select(
        "topic", "partition", "offset", "rowkey", F.col("sub_industry_id").alias("ids")
    )


@query(
    "enrichment_failures",
    CLEANED_MESSAGES_SQL
    + " SELECT rowkey, t AS post_content, 3 AS attempts, 'failed' AS enrich_status "
    "FROM cleaned WHERE t <> '' AND length(t) % 7 = 0",
)
def enrichment_failures(spark, sf):
    """Dead letters: posts the model never answered for."""
    enriched = enrich_messages(post_messages(spark, sf), dimension(spark, sf), stand_in_scorer)
    failed = E.split_failures(enriched)[1]
    return failed.select("rowkey", "post_content", "attempts", "enrich_status")


@query(
    "whitelisted_posts",
    f"""SELECT doc_id, {inputs.ids_text_sql('ids')} AS ids
FROM (SELECT doc_id, {inputs.word_ids_sql('text')} AS ids FROM documents) WHERE list_contains(ids, '0')""",
)
def whitelisted_posts(spark, sf):
    """Word lengths stay below 30, so only the code 0 can occur."""
    kept = E.keep_whitelisted(_documents_with_ids(spark, sf))
    return kept.select("doc_id", join_ids("sub_industry_id").alias("ids"))


@query(
    "route_messages",
    f"""SELECT topic, partition, "offset", CASE WHEN topic IN ('click', 'view') THEN 'cells' ELSE 'main' END AS route
FROM ({inputs.MESSAGES_SQL}) WHERE {inputs.IS_OBJECT_SQL}""",
)
def routed(spark, sf):
    messages = inputs.messages(spread(table(spark, sf, "events")))
    return route_messages(messages, ["click", "view"]).select("topic", "partition", "offset", "route")
