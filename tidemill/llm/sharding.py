"""Operator 9: shards of near-equal bytes by a minimax contiguous partition.

Equal texts form a group that stays together.  Groups stand in the order of their digest.  The smallest capacity for which
a greedy walk needs no more than the wanted number of shards is found by searching the capacities with several trial
values at a time; a walk's next cut is the last group end within the capacity, looked up in the distributed prefix sums.
The groups are cut there.

Cases: a null text counts no bytes and is a group of its own kind, apart from the empty text; repeated rows are members of
their group; an empty table gives no rows; a group larger than an even share fills a shard alone or with its neighbours;
slots follow (digest, doc_id, row); extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.staging import staged

SHARDS = 8
TRIALS = 255


def _sized(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.md5(text), F.lit("-")).alias("key"),
    )


def _running(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int, int]:
    """Rows in a global order with ``place`` (rows before) and ``begin`` (bytes before), and both totals.

    Ranges of the order, of a number that Spark's shuffle settings give, are summed; the sums are turned into offsets and
    only those (two numbers for each range) reach the driver.  Many equal keys are cut into ranges by the later columns.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "shard-rows")
    sums = {r["part"]: (r["n"], r["b"]) for r in ranged.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()}
    before, n, b = [], 0, 0
    for part in range(max(sums, default=-1) + 1):
        before.append((n, b))
        n, b = n + sums.get(part, (0, 0))[0], b + sums.get(part, (0, 0))[1]
    at = F.element_at(F.array(*[F.struct(F.lit(x).cast("long").alias("n"), F.lit(y).cast("long").alias("b")) for x, y in before or [(0, 0)]]), F.col("part") + 1)
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("place", F.coalesce(F.count("*").over(within), F.lit(0)) + at["n"]).withColumn("begin", F.coalesce(F.sum("size").over(within), F.lit(0)) + at["b"]),
        n,
        b,
    )


def _last_ends(ends: DataFrame, limits: np.ndarray) -> np.ndarray:
    """For each limit the largest group end that is no larger (0 if none)."""

    def batches(stream):
        best = np.zeros(len(limits), np.int64)
        for batch in stream:
            own = np.sort(np.asarray(batch.column("end")))
            if len(own):
                at = np.searchsorted(own, limits, "right") - 1
                best = np.maximum(best, np.where(at >= 0, own[np.maximum(at, 0)], 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(limits))), pa.array(best)], ["k", "end"])

    rows = ends.mapInArrow(batches, "k long, end long").groupBy("k").agg(F.max("end").alias("end")).collect()
    found = np.zeros(len(limits), np.int64)
    for row in rows:
        found[row["k"]] = row["end"]
    return found


def _walks(ends: DataFrame, capacities: np.ndarray, shards: int) -> np.ndarray:
    """Cuts of the greedy walk for each capacity: shards x capacities."""
    cuts, at = [], np.zeros(len(capacities), np.int64)
    for _ in range(shards):
        at = np.maximum(at, _last_ends(ends, at + capacities))
        cuts.append(at)
    return np.stack(cuts)


def smallest_capacity(ends: DataFrame, total: int, largest: int, shards: int, trials: int = TRIALS) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the cuts of its walk (``shards`` ends in bytes, the last is the total)."""
    low, high = max(-(-total // shards), largest), -(-total // shards) + largest  # the upper one is always feasible
    while True:
        span = high - low + 1
        capacities = np.unique(low + (np.arange(1, trials + 1) * span) // (trials + 1)) if span > trials else np.arange(low, high + 1)
        capacities = np.union1d(capacities, [high])
        cuts = _walks(ends, capacities, shards)
        good = int(np.flatnonzero(cuts[-1] >= total)[0])
        high, low = int(capacities[good]), low if good == 0 else int(capacities[good - 1]) + 1
        if low >= high:
            return high, [int(x) for x in cuts[:, good]]


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row, groups of equal texts kept whole."""
    sized, n, total = _running(_sized(docs), ["key", "doc_id"])
    rows = staged(sized.drop("part"), "shard-places")
    groups = rows.groupBy("key").agg(F.min("begin").alias("begin"), F.sum("size").alias("bytes"))
    ends = staged(groups.select((F.col("begin") + F.col("bytes")).alias("end"), "bytes"), "shard-ends")
    largest = ends.agg(F.max("bytes")).first()[0] or 0
    cuts = smallest_capacity(ends, total, largest, shards)[1] if total else [0] * shards
    shard = sum(((F.col("begin") >= c).cast("int") for c in cuts[:-1]), F.lit(0))
    placed = rows.withColumn("shard", shard)
    first = {r["shard"]: r["place"] for r in placed.groupBy("shard").agg(F.min("place").alias("place")).collect()}
    start = F.element_at(F.array(*[F.lit(first.get(k, 0)).cast("long") for k in range(shards)]), F.col("shard") + 1)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query("op9_shards")
def op9_shards(spark, sf_dir):
    return shard_by_bytes(table(spark, sf_dir, "documents"))
