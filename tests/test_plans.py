"""The physical plans the operators are meant to have."""

import re

from pyspark.sql import functions as F

from tidemill.operators import cells as C
from tidemill.operators import clean
from tidemill.operators import decode as D
from tidemill.operators import documents as X
from tidemill.operators import events as V
from tidemill.operators import messages as M
from tidemill.operators.evaluate import spread
from tidemill.plans.enrichment import enrich_posts
from tidemill.queries import inputs
from tidemill.queries.enrich import dimension, stand_in_scorer
from tidemill.queries.registry import table
from tidemill.session import shared_dir


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (hash|range|Single|RoundRobin)", text))


def test_cleaning_runs_once_without_shuffle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("post_content"))
    text = plan(clean.clean_posts(docs))
    condition = next(line for line in text.split("\n") if "Filter" in line)
    assert "regexp_replace" not in condition
    assert shuffles(text) == 0 and "Python" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "IsNotNull(text)" in text


def test_decoding_parses_once(spark, sf_dir):
    text = plan(D.decode_posts(inputs.post_messages(table(spark, sf_dir, "conversations").withColumn("t", F.col("text")))).good)
    assert text.count("from_json") == 1


def test_enrichment_has_no_join_on_the_posts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    posts = clean.as_posts(docs, {"rowkey": "doc_id", "post_content": "text"})
    text = plan(enrich_posts(posts, dimension(spark, sf_dir), stand_in_scorer, ["rowkey"]))
    outside = "\n".join(line for line in text.split("\n") if not re.match(r"^[+\- :]*: ", line))
    assert shuffles(outside) == 0 and "Join" not in outside
    assert "AS _table" not in text
    assert re.search(r"ArrowEvalPython \[score\(post_content#\d+\)#\d+\]", text)


def test_cell_projection_has_one_shuffle(spark):
    cells = spark.createDataFrame([], "rowkey string, family string, qualifier string, version long, value string")
    path = shared_dir(spark, "cells")
    cells.write.parquet(path)
    scan = spark.read.parquet(path)
    assert shuffles(plan(C.project_cells(scan, ["a", "b"]))) == 1
    pushed = plan(C.project_cells(scan, ["a", "b"], empty_rows=False))
    assert "EqualTo(family,info)" in pushed and "In(qualifier, [a,b])" in pushed


def test_latest_combines_before_the_shuffle(spark, sf_dir):
    text = plan(X.latest_by(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_orderkey")))
    assert shuffles(text) == 1 and "partial_max_by" in text and "Window" not in text


def test_small_delta_does_not_shuffle_the_table(spark, sf_dir):
    current = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    delta = current.filter("o_orderstatus = 'F'").withColumn("seq", F.lit(1))
    upserted = plan(X.upsert(current, delta, ["o_orderkey"], F.col("seq")))
    assert "BroadcastHashJoin" in upserted and "SortMergeJoin" not in upserted
    merged = plan(X.merge_supplied(current, delta.drop("seq"), ["o_orderkey"]))
    assert "SortMergeJoin" not in merged and shuffles(merged) == 0


def test_windows_aggregate_before_they_multiply(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = plan(V.sliding_hour(events, "ts", ["event_type"], "value"))
    assert "Expand" not in text
    generate = text.index("Generate explode")
    assert text.index("partial_count", generate) > generate  # the panes are below


def test_start_time_reaches_the_scan(spark, sf_dir):
    path = shared_dir(spark, "log")
    inputs.messages(table(spark, sf_dir, "events")).write.parquet(path)
    start = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert "GreaterThanOrEqual(timestamp" in plan(M.from_timestamp(spark.read.parquet(path), start))


def test_spread_leaves_wide_inputs_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == cores
    wide = spark.range(100, numPartitions=cores + 3)
    assert spread(wide) is wide
