"""Cell tables, document tables, files and sink shapes."""

from pyspark.sql import functions as F

from tidemill.operators import cells as C
from tidemill.operators import documents as X
from tidemill.operators import messages as M
from tidemill.plans.seeding import seed_messages
from tidemill.operators.evaluate import spread
from tidemill.queries import inputs
from tidemill.queries.decode import TIMED_SQL
from tidemill.queries.keys import GROUPS_SQL
from tidemill.queries.registry import query, table
from tidemill.session import shared_dir
from tidemill.sources import files
from tidemill.sources.sorted_cells import SortedCells

# -- cells -----------------------------------------------------------------------

# two versions: the second changes the status of some orders and has no other field
ORDER_FIELDS = ["o_orderstatus", "o_orderpriority", "o_custkey", "note"]


def order_cells(spark, sf):
    orders = spread(table(spark, sf, "orders")).withColumn("rowkey", F.col("o_orderkey").cast("string"))
    note = F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate").cast("date").cast("string"))
    first = orders.select("rowkey", *ORDER_FIELDS[:3], note.alias("note"))
    changed = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("X-"), "o_orderstatus"))
    second = orders.select("rowkey", changed.alias("o_orderstatus"))
    other = orders.select("rowkey", F.lit("old").alias("o_orderstatus"))
    return (
        C.to_cells(first, version=1)
        .unionByName(C.to_cells(second, version=2))
        .unionByName(C.to_cells(other, version=0, family="meta"))
    )


STATUS_SQL = "CASE WHEN o_orderkey % 3 = 0 THEN 'X-' || o_orderstatus ELSE o_orderstatus END"
NOTE_SQL = "CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END"


@query(
    "project_cells",
    f"""SELECT o_orderkey::VARCHAR AS rowkey, {STATUS_SQL} AS o_orderstatus, o_orderpriority,
o_custkey::VARCHAR AS o_custkey, {NOTE_SQL} AS note FROM orders""",
)
def project_cells(spark, sf):
    return C.project_cells(order_cells(spark, sf), ORDER_FIELDS)


@query(
    "latest_cells",
    f"""WITH o AS (SELECT *, {STATUS_SQL} AS s, {NOTE_SQL} AS note FROM orders)
SELECT o_orderkey::VARCHAR AS rowkey, 'info' AS family, 'o_orderstatus' AS qualifier,
(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END)::BIGINT AS version, s AS value FROM o
UNION ALL SELECT o_orderkey::VARCHAR, 'info', 'o_orderpriority', 1, o_orderpriority FROM o
UNION ALL SELECT o_orderkey::VARCHAR, 'info', 'o_custkey', 1, o_custkey::VARCHAR FROM o
UNION ALL SELECT o_orderkey::VARCHAR, 'info', 'note', 1, note FROM o WHERE note IS NOT NULL
UNION ALL SELECT o_orderkey::VARCHAR, 'meta', 'o_orderstatus', 0, 'old' FROM o""",
)
def latest_cells(spark, sf):
    return C.latest_cells(order_cells(spark, sf))


@query(
    "get_rows",
    f"""SELECT c_custkey::VARCHAR AS rowkey, CASE WHEN o_orderkey IS NULL THEN '' ELSE
concat_ws(',', CASE WHEN o_orderstatus = 'O' THEN 'note=' || strftime(o_orderdate, '%Y-%m-%d') END,
'o_custkey=' || o_custkey, 'o_orderpriority=' || o_orderpriority, 'o_orderstatus=' || {STATUS_SQL}) END AS cells
FROM customer LEFT JOIN orders ON o_orderkey = c_custkey""",
)
def get_rows(spark, sf):
    """Point gets of order rows by the customer numbers, some of them unknown."""
    keys = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("rowkey"))
    rows = C.get_rows(order_cells(spark, sf), keys, family="info")
    entries = F.array_sort(F.map_entries("cells"))
    text = F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.select("rowkey", F.array_join(text, ",").alias("cells"))


LINE_FILES = 64


def _line_cells(spark, sf):
    """Order lines as cells, a column family for each line status; keys sort as numbers do."""
    lines = table(spark, sf, "lineitem").select(
        F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("rowkey"),
        F.col("l_linestatus").alias("family"),
        F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("qualifier"),
        F.col("l_partkey").cast("long").alias("version"),
        F.col("l_suppkey").cast("string").alias("value"),
    )
    kept = SortedCells(shared_dir(spark, "sorted-cells"))
    kept.write(lines, LINE_FILES)
    return kept


LINE_CELLS_SQL = """c AS (SELECT lpad(l_orderkey::VARCHAR, 12, '0') AS rowkey, l_linestatus AS family,
'line' || l_linenumber AS qualifier, l_partkey::BIGINT AS version, max(l_suppkey::VARCHAR) AS value
FROM lineitem GROUP BY ALL)"""


@query("sorted_cells", f"WITH {LINE_CELLS_SQL} SELECT * FROM c")
def sorted_cells(spark, sf):
    """All cells of the layout, repeated ones once."""
    return _line_cells(spark, sf).read(spark)


@query(
    "sorted_cell_scan",
    f"""WITH {LINE_CELLS_SQL}, r AS (SELECT lpad((max(l_orderkey) // 4)::VARCHAR, 12, '0') AS a,
lpad((max(l_orderkey) // 2)::VARCHAR, 12, '0') AS b FROM lineitem) SELECT c.* FROM c, r WHERE rowkey >= a AND rowkey < b""",
)
def sorted_cell_scan(spark, sf):
    """The second quarter of the row keys."""
    greatest = table(spark, sf, "lineitem").agg(F.max("l_orderkey")).first()[0] or 0
    return _line_cells(spark, sf).scan(spark, f"{greatest // 4:012d}", f"{greatest // 2:012d}")


@query(
    "sorted_cell_get",
    f"""WITH {LINE_CELLS_SQL}, n AS (SELECT rowkey, qualifier, value FROM c
QUALIFY row_number() OVER (PARTITION BY rowkey, qualifier ORDER BY version DESC, family DESC, value DESC) = 1),
k AS (SELECT DISTINCT lpad((o_orderkey + CASE WHEN o_orderkey % 7 = 0 THEN 1000000000 ELSE 0 END)::VARCHAR, 12, '0') AS rowkey
FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT rowkey, coalesce(string_agg(qualifier || '=' || value, ',' ORDER BY qualifier), '') AS cells
FROM k LEFT JOIN n USING (rowkey) GROUP BY rowkey""",
)
def sorted_cell_get(spark, sf):
    """Urgent orders by key, some of them unknown, from the files that may hold them."""
    number = F.col("o_orderkey") + F.when(F.col("o_orderkey") % 7 == 0, 1_000_000_000).otherwise(0)
    urgent = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    rows = _line_cells(spark, sf).get(urgent.select(F.lpad(number.cast("string"), 12, "0").alias("rowkey")))
    text = F.transform(F.array_sort(F.map_entries("cells")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.select("rowkey", F.array_join(text, ",").alias("cells"))


CUSTOMER_CELLS_SQL = """WITH c AS (SELECT c_custkey::VARCHAR AS rowkey, c_name,
CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment, c_nationkey::VARCHAR AS c_nationkey FROM customer)
SELECT rowkey, 'info' AS family, qualifier, 7::BIGINT AS version, value
FROM c UNPIVOT (value FOR qualifier IN (c_name, c_mktsegment, c_nationkey))"""


@query("documents_to_cells", CUSTOMER_CELLS_SQL)
def documents_to_cells(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("rowkey"),
        "c_name",
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_nationkey",
    )
    return C.to_cells(customers, version=7)


TOPIC_TABLES = {"click": "web:clicks", "view": "web:views"}


@query(
    "record_cells",
    f"""WITH g AS (SELECT * FROM ({TIMED_SQL}) WHERE ok AND topic IN ('click', 'view')),
n AS (SELECT *, lpad(md5(json_extract_string(value, '$.name')), 35, '0') AS h FROM g),
k AS (SELECT CASE topic WHEN 'click' THEN 'web:clicks' ELSE 'web:views' END AS "table",
ltrim({GROUPS_SQL}, '0') AS rowkey, "offset" AS version,
json_extract_string(value, '$.name') AS adid, json_extract_string(value, '$.age') AS adname,
json_extract_string(value, '$.time') AS dn FROM n)
SELECT "table", rowkey, 'info' AS family, qualifier, version, value
FROM k UNPIVOT (value FOR qualifier IN (adid, adname, dn))""",
)
def record_cells(spark, sf):
    messages = inputs.messages(spread(table(spark, sf, "events")))
    return C.record_cells(messages, TOPIC_TABLES, version=F.col("offset"))


@query(
    "time_keyed_cells",
    """WITH e AS (SELECT (epoch_us(ts) // 1000) || '-' || event_id AS rowkey, epoch_us(ts) // 1000 AS version, * FROM events)
SELECT rowkey, 'info' AS family, 'event_type' AS qualifier, version, hex(event_type) AS value FROM e
UNION ALL SELECT rowkey, 'info', 'user_id', version, lpad(to_hex(user_id), 16, '0') FROM e
UNION ALL SELECT rowkey, 'info', 'k', version,
lpad(to_hex(json_extract(props, '$.k')::BIGINT), 8, '0') FROM e""",
)
def time_keyed_cells(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "ts", "event_type", "user_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    types = {"event_type": "string", "user_id": "long", "k": "int"}
    cells = C.time_keyed_cells(events, types, inputs.epoch_ms(), F.col("event_id"))
    return cells.withColumn("value", F.hex("value"))


# -- documents --------------------------------------------------------------------


def order_documents(spark, sf):
    metadata = F.create_map(
        F.lit("_index"), F.lit("orders"),
        F.lit("_id"), F.col("o_orderkey").cast("string"),
        F.lit("_score"), F.lit("1.0"),
    )
    return table(spark, sf, "orders").select(
        metadata.alias("_metadata"),
        "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("update_time"),
    )


META_SQL = "'orders' AS meta_index, o_orderkey::VARCHAR AS meta_id, '1.0' AS meta_score"
UPDATED_SQL = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"


@query("document_field", f"SELECT {META_SQL}, o_orderstatus FROM orders")
def document_field(spark, sf):
    return X.scan_documents(order_documents(spark, sf), "o_orderstatus")


@query(
    "document_updates",
    f"SELECT {META_SQL}, {UPDATED_SQL} AS update_time FROM orders ORDER BY update_time NULLS FIRST",
)
def document_updates(spark, sf):
    return X.scan_updates(order_documents(spark, sf))


@query("document_metadata", f"SELECT {META_SQL} FROM orders")
def document_metadata(spark, sf):
    return X.scan_documents(order_documents(spark, sf))


@query("high_water_mark", f"SELECT max({UPDATED_SQL}) AS high_water_mark FROM orders")
def high_water_mark(spark, sf):
    return X.high_water_mark(order_documents(spark, sf))


@query(
    "changed_since",
    f"""SELECT {META_SQL}, {UPDATED_SQL} AS update_time FROM orders
WHERE {UPDATED_SQL} > (SELECT strftime(max(o_orderdate) - INTERVAL 90 DAY, '%Y-%m-%d %H:%M:%S') FROM orders)""",
)
def changed_since(spark, sf):
    """Documents newer than the newest one of an index loaded 90 days before."""
    shifted = F.expr("date_format(o_orderdate - INTERVAL 90 DAYS, 'yyyy-MM-dd HH:mm:ss')")
    loaded = table(spark, sf, "orders").select(shifted.alias("update_time"))
    changed = X.changed_since(order_documents(spark, sf), X.high_water_mark(loaded))
    return X.scan_documents(changed, "update_time")


@query(
    "preview_rows",
    f"""SELECT {META_SQL}, {UPDATED_SQL} AS update_time FROM orders
ORDER BY update_time NULLS FIRST, meta_id NULLS FIRST LIMIT 200""",
)
def preview_rows(spark, sf):
    documents = X.scan_documents(order_documents(spark, sf), "update_time")
    return X.preview(documents, ["update_time", "meta_id"])


@query(
    "upsert_documents",
    """WITH n AS (SELECT o_custkey + 100 AS meta_id, 'order ' || o_orderkey AS name, o_orderstatus AS status
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT * FROM n UNION ALL
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT meta_id FROM n)""",
)
def upsert_documents(spark, sf):
    """Customer documents, overwritten by the newest order of a customer; the
    shifted numbers make some documents new."""
    current = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("meta_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("status"),
    )
    delta = table(spark, sf, "orders").select(
        (F.col("o_custkey") + 100).alias("meta_id"),
        F.concat(F.lit("order "), "o_orderkey").alias("name"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("seq"),
    )
    return X.upsert(current, delta, ["meta_id"], F.col("seq"))


@query(
    "append_documents",
    "SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus, true AS has_id FROM orders",
)
def append_documents(spark, sf):
    """The generated id differs on every run and is only checked for being there."""
    rows = X.stringify(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"))
    return rows.select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.length("meta_id") == 36).alias("has_id")
    )


@query(
    "merge_supplied",
    """WITH d AS (SELECT o_custkey + 100 AS c_custkey,
CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS c_mktsegment
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT coalesce(c.c_custkey, d.c_custkey) AS c_custkey, c_name,
CASE WHEN d.c_custkey IS NOT NULL THEN d.c_mktsegment ELSE c.c_mktsegment END AS c_mktsegment
FROM customer c FULL OUTER JOIN d ON c.c_custkey = d.c_custkey""",
)
def merge_supplied(spark, sf):
    """The delta supplies the segment, in part as NULL, and not the name."""
    current = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = table(spark, sf, "orders").select(
        (F.col("o_custkey") + 100).alias("c_custkey"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("c_mktsegment"),
        "o_orderkey",
    )
    delta = X.latest_by(orders, ["c_custkey"], F.col("o_orderkey")).drop("o_orderkey")
    return X.merge_supplied(current, delta, ["c_custkey"])


# -- message shapes -----------------------------------------------------------------


@query(
    "to_topic",
    """SELECT 'customers' AS topic, c_custkey::BIGINT AS c_custkey, c_name,
CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer""",
)
def to_topic(spark, sf):
    segment = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", segment)
    return M.to_topic(customers, "customers").select(
        "topic",
        F.get_json_object("value", "$.c_custkey").cast("long").alias("c_custkey"),
        F.get_json_object("value", "$.c_name").alias("c_name"),
        F.get_json_object("value", "$.c_mktsegment").alias("c_mktsegment"),
    )


@query(
    "to_row_topics",
    "SELECT lang AS topic, true AS no_key, hex(text) AS value FROM documents",
)
def to_row_topics(spark, sf):
    rows = M.to_row_topics(table(spark, sf, "documents"), "lang", "text")
    return rows.select("topic", F.isnull("key").alias("no_key"), F.hex("value").alias("value"))


@query(
    "hash_upsert",
    """SELECT 'user_events' AS hash, 'u' || user_id AS field, max_by(event_type, event_id) AS value
FROM events GROUP BY user_id""",
)
def hash_upsert(spark, sf):
    """Entries of one hash; the last value of each field stays."""
    events = table(spark, sf, "events")
    latest = X.latest_by(
        events.select("user_id", "event_type", "event_id"), ["user_id"], F.col("event_id")
    )
    return M.to_hash(latest, "user_events", F.concat(F.lit("u"), F.col("user_id")), "event_type")


@query(
    "seed_topic",
    """SELECT 'media' AS topic, o_orderkey::VARCHAR AS rowkey, o_orderstatus AS type,
'clerk' AS media, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS post_content,
3 + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS fields FROM orders""",
)
def seed_topic(spark, sf):
    orders = spread(table(spark, sf, "orders")).select(
        F.col("o_orderkey").cast("string").alias("rowkey"),
        F.col("o_orderstatus").alias("type"),
        F.lit("clerk").alias("media"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("post_content"),
        F.col("o_custkey").alias("unused"),
    )
    messages = seed_messages(C.to_cells(orders), "media")
    field = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return messages.select(
        "topic",
        *[field(name) for name in ("rowkey", "type", "media", "post_content")],
        F.size(F.json_object_keys("value")).alias("fields"),
    )


# -- files ----------------------------------------------------------------------------


@query("csv_scan", "SELECT c_custkey::BIGINT AS c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf):
    """Customers written with blanks around the names and read back."""
    base = shared_dir(spark, "csv")
    padded = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"), "c_acctbal", "c_mktsegment"
    )
    padded.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{base}/customer")
    back = files.read_csv(spark, base, "customer")
    return back.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("orc_scan", "SELECT * FROM supplier")
def orc_scan(spark, sf):
    base = shared_dir(spark, "orc")
    table(spark, sf, "supplier").write.orc(f"{base}/test_data/supplier")
    return files.read_orc(spark, base, "supplier")


@query(
    "comma_records",
    """SELECT 'u' || user_id AS name, (user_id % 90)::INTEGER AS age, strftime(ts, '%Y-%m-%d') AS time
FROM events WHERE event_id % 11 <> 0 AND event_id % 7 <> 0""",
)
def comma_records(spark, sf):
    return _comma_lines(spark, sf).good


@query(
    "comma_rejects",
    """SELECT 'u' || user_id || ',' || CASE WHEN event_id % 11 = 0 THEN 'x' ELSE (user_id % 90)::VARCHAR END || ','
|| CASE WHEN event_id % 7 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS value
FROM events WHERE event_id % 11 = 0 OR event_id % 7 = 0""",
)
def comma_rejects(spark, sf):
    return _comma_lines(spark, sf).rejects


def _comma_lines(spark, sf):
    """Lines written as text; some lack the time or have no numeric age."""
    base = shared_dir(spark, "lines")
    age = F.when(F.col("event_id") % 11 == 0, "x").otherwise((F.col("user_id") % 90).cast("string"))
    time = F.when(F.col("event_id") % 7 == 0, "").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    line = F.concat_ws(",", F.concat(F.lit("u"), "user_id"), age, time)
    table(spark, sf, "events").select(line.alias("value")).write.text(base)
    return files.comma_records(files.read_lines(spark, base))


@query(
    "ampersand_posts",
    """SELECT role AS post_user_name, conv_id || '-' || turn AS rowkey, 1614666023000 + conv_id AS event_ms,
'a & b, ' || replace(text, chr(10), ' ') AS post_content FROM conversations""",
)
def ampersand_posts(spark, sf):
    posts = _ampersand_lines(spark, sf, F.lit(1614666023000) + F.col("conv_id")).good
    return posts.select(
        "post_user_name", "rowkey", F.unix_millis("event_time").alias("event_ms"), "post_content"
    )


@query(
    "ampersand_rejects",
    """SELECT '"' || role || '"&"' || conv_id || '-' || turn || '"&later&a & b, ' || replace(text, chr(10), ' ') AS value
FROM conversations WHERE conv_id % 5 = 0""",
)
def ampersand_rejects(spark, sf):
    """Lines without a time."""
    time = F.when(F.col("conv_id") % 5 == 0, "later").otherwise(F.col("conv_id").cast("string"))
    return _ampersand_lines(spark, sf, time).rejects


def _ampersand_lines(spark, sf, time):
    base = shared_dir(spark, "posts")
    line = F.concat_ws(
        "&",
        F.concat(F.lit('"'), "role", F.lit('"')),
        F.concat(F.lit('"'), "conv_id", F.lit("-"), "turn", F.lit('"')),
        time,
        F.concat(F.lit("a & b, "), F.replace(F.col("text"), F.lit("\n"), F.lit(" "))),
    )
    table(spark, sf, "conversations").select(line.alias("value")).write.text(base)
    return files.ampersand_posts(files.read_lines(spark, base))
