"""Tables kept by key on files, every batch delivered twice."""

from pyspark.sql import functions as F

from tidemill.operators.cells import CELL_KEY, project_cells, to_cells
from tidemill.queries.registry import query, table
from tidemill.session import shared_dir
from tidemill.streaming.keyed import KeyedTable

BUCKETS = 16
FAR = 1_000_000_000_000


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer")
    )


def _changes(spark, sf):
    """Status by line for every third order, and for orders not known yet."""
    lines = table(spark, sf, "lineitem").where("l_orderkey % 3 = 0")
    number = F.col("l_orderkey") + F.when(F.col("l_orderkey") % 2 == 0, FAR).otherwise(0)
    return lines.select(
        number.alias("id"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("status"), "l_linenumber"
    )


CHANGES_SQL = f"""SELECT l_orderkey + CASE WHEN l_orderkey % 2 = 0 THEN {FAR} ELSE 0 END AS id,
l_linestatus || l_linenumber AS status FROM lineitem WHERE l_orderkey % 3 = 0
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_linestatus DESC) = 1"""


def last_line():
    return F.struct("l_linenumber", "status")


def _order_table(spark, label):
    return KeyedTable(shared_dir(spark, label), "id long, status string, customer long", ["id"], BUCKETS)


@query(
    "upsert_table",
    f"""WITH c AS ({CHANGES_SQL}) SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS customer FROM orders
WHERE o_orderkey NOT IN (SELECT id FROM c) UNION ALL SELECT id, status, NULL FROM c""",
)
def upsert_table(spark, sf):
    """Whole rows replaced or added; the last line of an order counts."""
    kept = _order_table(spark, "upserts")
    for _ in range(2):
        kept.upsert(_orders(spark, sf), stream="orders", batch=0)
        kept.upsert(_changes(spark, sf), last_line(), stream="orders", batch=1)
    return kept.read(spark)


@query(
    "supply_table",
    f"""WITH c AS ({CHANGES_SQL}) SELECT coalesce(o_orderkey, id) AS id,
CASE WHEN id IS NULL THEN o_orderstatus ELSE status END AS status, o_custkey AS customer
FROM orders FULL JOIN c ON o_orderkey = id""",
)
def supply_table(spark, sf):
    """Only the supplied column changes."""
    kept = _order_table(spark, "supplies")
    for _ in range(2):
        kept.upsert(_orders(spark, sf), stream="orders", batch=0)
        kept.supply(_changes(spark, sf), last_line(), stream="lines", batch=0)
    return kept.read(spark)


@query(
    "get_from_table",
    f"""WITH c AS ({CHANGES_SQL}), t AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS customer FROM orders
WHERE o_orderkey NOT IN (SELECT id FROM c) UNION ALL SELECT id, status, NULL FROM c)
SELECT * FROM t WHERE id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)""",
)
def get_from_table(spark, sf):
    """Keys looked up in the buckets that hold them."""
    kept = _order_table(spark, "gets")
    kept.upsert(_orders(spark, sf))
    kept.upsert(_changes(spark, sf), last_line())
    return kept.get(table(spark, sf, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("id")))


@query(
    "cell_table",
    """SELECT doc_id::VARCHAR AS rowkey, CASE WHEN doc_id % 2 = 0 THEN 'new ' || lang ELSE lang END AS lang, source,
CASE WHEN doc_id % 2 = 0 THEN n_chars::VARCHAR END AS n_chars FROM documents""",
)
def cell_table(spark, sf):
    """Newer cells replace, older ones that come late do not, other cells of the row stay."""
    rows = table(spark, sf, "documents").withColumn("rowkey", F.col("doc_id").cast("string"))
    kept = KeyedTable(
        shared_dir(spark, "cells"), "rowkey string, family string, qualifier string, version long, value string", list(CELL_KEY), BUCKETS
    )
    first = to_cells(rows.select("rowkey", "lang", "source"), version=5)
    changed = F.concat(F.lit("new "), "lang").alias("lang")
    second = to_cells(rows.where("doc_id % 2 = 0").select("rowkey", changed, "n_chars"), version=6)
    stale = to_cells(rows.where("doc_id % 3 = 0").select("rowkey", F.lit("old").alias("lang")), version=4)
    for _ in range(2):
        for number, cells in enumerate((first, second, stale)):
            kept.put_cells(cells, stream="cells", batch=number)
    return project_cells(kept.read(spark), ["lang", "source", "n_chars"])
