"""Cleaning steps and profiles."""

from pyspark.sql import functions as F

from tidemill.functions import jsons
from tidemill.functions import text as T
from tidemill.operators import clean
from tidemill.operators.evaluate import spread
from tidemill.queries import inputs
from tidemill.queries import sqltext as S
from tidemill.queries.registry import query, table

DOCS = inputs.DOCUMENTS_SQL
CONVS = inputs.CONVERSATIONS_SQL


@query(
    "clean_documents",
    S.clean_chain(DOCS) + " SELECT doc_id, t AS post_content FROM cleaned WHERE t <> ''",
)
def clean_documents(spark, sf):
    docs = inputs.documents(spark, sf).select("doc_id", F.col("t").alias("post_content"))
    return clean.clean_posts(docs)


@query(
    "clean_conversations",
    S.clean_chain(CONVS) + " SELECT conv_id, turn, t AS post_content FROM cleaned WHERE t <> ''",
)
def clean_conversations(spark, sf):
    turns = inputs.conversations(spark, sf)
    return clean.clean_posts(turns.select("conv_id", "turn", F.col("t").alias("post_content")))


@query(
    "clean_keep_empty",
    S.clean_chain(CONVS) + " SELECT conv_id, turn, t AS post_content FROM cleaned",
)
def clean_keep_empty(spark, sf):
    turns = inputs.conversations(spark, sf)
    posts = turns.select("conv_id", "turn", F.col("t").alias("post_content"))
    return clean.clean_posts(posts, keep_empty=True)


@query("strip_documents", S.strip_chain(DOCS) + " SELECT doc_id, t AS stripped FROM stripped")
def strip_documents(spark, sf):
    """Every step but the length gate, so that long texts are compared too."""
    docs = inputs.documents(spark, sf).select("doc_id", F.col("t").alias("stripped"))
    return clean.strip_posts(docs, "stripped")


@query(
    "strip_pages",
    S.strip_chain("SELECT page_id, html AS t FROM pages")
    + " SELECT page_id, t AS stripped FROM stripped",
)
def strip_pages(spark, sf):
    return spread(table(spark, sf, "pages")).select("page_id", T.strip_post("html").alias("stripped"))


@query(
    "clean_basic",
    S.clean_chain_basic(CONVS) + " SELECT conv_id, turn, t AS post_content FROM cleaned WHERE t <> ''",
)
def clean_basic(spark, sf):
    turns = inputs.conversations(spark, sf)
    posts = turns.select("conv_id", "turn", F.col("t").alias("post_content"))
    return clean.clean_posts(posts, profile="basic")


def _step(name, step, sql):
    @query(name, f"SELECT doc_id, {sql('t')} AS result FROM ({DOCS})")
    def run(spark, sf):
        return inputs.documents(spark, sf).select("doc_id", step("t").alias("result"))


_step("remove_noise", T.remove_noise, S.noise)
_step("remove_symbols", T.remove_symbols, S.symbols)
_step("remove_emoji", T.remove_emoji, S.emoji)
_step("mark_websites", T.mark_websites, S.marked)
_step("remove_replacement_chars", T.remove_replacement_chars, S.no_replacement)
_step("remove_unicode_escapes", T.remove_unicode_escapes, S.no_escapes)
_step("collapse_spaces", T.collapse_spaces, S.spaced)
_step("length_gate", T.length_gate, S.gated)
_step("tidy_commas", lambda c: T.join_sentences(T.split_sentences(c)), lambda x: S.joined(S.sentences(x)))


@query(
    "split_sentences",
    f"SELECT doc_id, len(s) AS sentences, array_to_string(s, '|') AS result "
    f"FROM (SELECT doc_id, {S.sentences('t')} AS s FROM ({DOCS}))",
)
def split_sentences(spark, sf):
    split = inputs.documents(spark, sf).select("doc_id", T.split_sentences("t").alias("s"))
    return split.select(
        "doc_id",
        F.size("s").cast("long").alias("sentences"),
        F.array_join("s", "|").alias("result"),
    )


@query(
    "drop_website_sentences",
    f"SELECT page_id, len(s) AS sentences, array_to_string(s, '|') AS result FROM "
    f"(SELECT page_id, {S.unmarked(S.sentences('t'))} AS s "
    f"FROM (SELECT page_id, {S.marked('html')} AS t FROM pages))",
)
def drop_website_sentences(spark, sf):
    marked = table(spark, sf, "pages").select("page_id", T.mark_websites("html").alias("t"))
    kept = marked.select("page_id", T.drop_website_sentences(T.split_sentences("t")).alias("s"))
    return kept.select(
        "page_id",
        F.size("s").cast("long").alias("sentences"),
        F.array_join("s", "|").alias("result"),
    )


@query(
    "post_projection",
    f"""SELECT conv_id || '-' || turn AS rowkey, turn::VARCHAR AS type, role AS post_user_name,
t AS post_content, NULL::VARCHAR AS dw_gofish_media_id, 'chat' AS media FROM ({CONVS})""",
)
def post_projection(spark, sf):
    return clean.as_posts(
        inputs.conversations(spark, sf),
        {
            "rowkey": F.concat_ws("-", "conv_id", "turn"),
            "type": "turn",
            "post_user_name": "role",
            "post_content": "t",
            "media": F.lit("chat"),
        },
    )


@query(
    "industry_whitelist",
    f"""SELECT doc_id, list_has_any({inputs.word_ids_sql('text')}, ['0', '75', '907', '230', '847',
'449', '36', '757', '745']) AS listed FROM documents""",
)
def industry_whitelist(spark, sf):
    ids = inputs.word_ids("text")
    return spread(table(spark, sf, "documents")).select("doc_id", jsons.in_whitelist(ids).alias("listed"))


@query(
    "join_ids",
    f"SELECT doc_id, {inputs.ids_text_sql(inputs.word_ids_sql('text'))} AS ids FROM documents",
)
def join_ids(spark, sf):
    ids = inputs.word_ids("text")
    return spread(table(spark, sf, "documents")).select("doc_id", jsons.join_ids(ids).alias("ids"))
