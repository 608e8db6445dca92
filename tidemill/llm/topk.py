"""Operator 3: exact top-k inner products with a pivot-distance index.

Vectors become integers, floor(1024 x).  With one more coordinate, sqrt(M - |x|^2) for the largest squared norm M and 0 for
a query, the largest inner product is the smallest distance.  Every vector is keyed by its nearest pivot and its distance
to that; the keys are cut into blocks of neighbouring distances (annuli of one pivot).  A query first searches the
nearest annulus, which gives it a k-th best score; every further block whose distance from the query is, by the triangle
inequality, too large for a better or equal score is passed over.  Inside a block the same bound narrows the rows.

Pivots are a bounded sample (``pivots`` rows with the smallest hashes); all vectors are indexed, so results are exact.

Cases: vectors null, empty, or with a null or non-finite component take no part; ids null take no part; vectors of another
length than a query's are no candidates of it; a query's own row is the one with its vec_id, so rows that repeat an id
are each other's own, and of query rows that repeat an id the one with the smallest vector asks; scores must fit in 64 bits, and sums beyond 2**53 are taken with integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.staging import staged

K = 10
BLOCK = 2048
#: Pivots and annuli up to this number go to every task; with more, blocks are made larger.
BROADCAST_ANNULI = 200_000


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, v array<long>, dim`` of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(F.coalesce(good, F.lit(False)))
    return rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x * 1024).cast("long")).alias("v"), F.size("embedding").alias("dim"))


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


class Pivots:
    """Pivot vectors and the largest squared norm, for one length of vectors."""

    def __init__(self, points: np.ndarray, norm: float):
        self.points, self.norm = points.astype(np.float64), norm
        self.lift = np.sqrt(np.maximum(norm - (self.points**2).sum(axis=1), 0))

    def distances(self, x: np.ndarray, lift: np.ndarray) -> np.ndarray:
        """Distances of lifted rows to all pivots."""
        square = (x**2).sum(axis=1) + lift**2
        own = (self.points**2).sum(axis=1) + self.lift**2
        return np.sqrt(np.maximum(square[:, None] + own[None, :] - 2 * (x @ self.points.T + lift[:, None] * self.lift[None, :]), 0))

    def keyed(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = v.astype(np.float64)
        far = self.distances(x, np.sqrt(np.maximum(self.norm - (x**2).sum(axis=1), 0)))
        near = far.argmin(axis=1)
        return near, far[np.arange(len(x)), near]

    def of_queries(self, v: np.ndarray) -> np.ndarray:
        return self.distances(v.astype(np.float64), np.zeros(len(v)))


def _choose_pivots(rows: DataFrame, pivots: int) -> dict[int, Pivots]:
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    largest = {r["dim"]: r["m"] for r in rows.groupBy("dim").agg(F.max(norm).alias("m")).collect()}
    out = {}
    for dim, most in sorted(largest.items()):
        chosen = rows.where(F.col("dim") == dim).select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(pivots).collect()
        out[dim] = Pivots(np.array([r["v"] for r in chosen], np.float64), float(most))
    return out


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, exact: with doubles while no sum can pass 2**53."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64) if bound < 2**53 else q @ x.T


def _best(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray, own: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of each query in a block: score falling, then id rising; the query's own id is left out."""
    order = np.argsort(ids, kind="stable")
    ids, scores, own = ids[order], scores[:, order], own[:, order]
    rank = np.where(own, scores, np.iinfo(np.int64).min)
    at = len(ids) - min(k, len(ids))  # not by negation: the least number is its own negative
    floor = np.partition(rank, at, axis=1)[:, at : at + 1]
    a, b = np.nonzero((rank >= floor) & own)
    frame = pd.DataFrame({"query_id": queries[a], "vec_id": ids[b], "score": scores[a, b]})
    frame = frame.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return frame.groupby("query_id", sort=False).head(k)


def _search(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    """All queries of one group against its block's rows."""
    asks, rows = frame[frame["ask"]], frame[~frame["ask"]].sort_values("far")
    if not len(asks) or not len(rows):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
    q, x, ids, far = _matrix(asks["v"]), _matrix(rows["v"]), rows["vec_id"].to_numpy(), rows["far"].to_numpy()
    queries, asked = asks["vec_id"].to_numpy(), asks["far"].to_numpy()
    reach = asks["reach"].to_numpy()
    low, high = np.searchsorted(far, (asked - reach).min()), np.searchsorted(far, (asked + reach).max(), "right")
    x, ids, far = x[low:high], ids[low:high], far[low:high]
    if not len(ids):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
    able = (ids[None, :] != queries[:, None]) & (np.abs(far[None, :] - asked[:, None]) <= reach[:, None])
    return _best(queries, ids, _scores(q, x), able, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, *, k: int = K, pivots: int = 64, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that the condition ``is_query`` marks, against all rows."""
    spark = vectors.sparkSession
    rows = staged(integer_vectors(vectors), "topk-vectors")
    index = _choose_pivots(rows, pivots)

    def keyed(stream):
        for batch in stream:
            frame = batch.to_pandas()
            for dim, part in frame.groupby("dim"):
                near, far = index[dim].keyed(_matrix(part["v"]))
                yield pa.RecordBatch.from_pandas(pd.DataFrame({"vec_id": part["vec_id"], "v": part["v"], "dim": part["dim"], "pivot": near, "far": far}), preserve_index=False)

    schema = "vec_id long, v array<long>, dim int, pivot long, far double"
    total = rows.count()
    size = max(block, -(-total // BROADCAST_ANNULI))
    parts = max(1, -(-total // size))
    places = rows.mapInArrow(keyed, schema).repartitionByRange(parts, "dim", "pivot", "far", "vec_id").withColumn("part", F.spark_partition_id())
    blocks = staged(places, "topk-blocks")
    annuli = blocks.groupBy("part", "dim", "pivot").agg(F.min("far").alias("low"), F.max("far").alias("high")).toPandas()

    queries = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("one")).select("vec_id", "one.v", "one.dim")

    def visits(first: bool):
        def go(stream):
            for batch in stream:
                frame = batch.to_pandas()
                for dim, part in frame.groupby("dim"):
                    own = annuli[annuli["dim"] == dim]
                    v = _matrix(part["v"])
                    far = index[dim].of_queries(v)
                    away = far[:, own["pivot"].to_numpy()]
                    gap = np.maximum(np.maximum(own["low"].to_numpy() - away, away - own["high"].to_numpy()), 0)
                    nearest = np.lexsort((np.broadcast_to(own["part"].to_numpy(), away.shape), away, gap), axis=1)[:, 0]
                    if first:
                        a, b, reach = np.arange(len(v)), nearest, np.full(len(v), np.inf)
                    else:
                        # score >= s means distance^2 <= |q|^2 + norm - 2 s; the slack covers rounding
                        floor = part["floor"].to_numpy(np.float64)
                        square = (v.astype(np.float64) ** 2).sum(axis=1) + index[dim].norm - 2 * np.where(np.isnan(floor), 0, floor)
                        limit = np.where(np.isnan(floor), np.inf, np.sqrt(np.maximum(square, 0)) * (1 + 1e-9) + 1e-3)
                        open_ = gap <= limit[:, None]
                        open_[np.arange(len(v)), nearest] = False
                        a, b = np.nonzero(open_)
                        reach = limit[a]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own["part"].to_numpy()[b].astype(np.int64)), pa.array(own["pivot"].to_numpy()[b].astype(np.int64)), pa.array(part["vec_id"].to_numpy()[a]), pa.array([x for x in part["v"].to_numpy()[a]], pa.list_(pa.int64())), pa.array(part["dim"].to_numpy()[a].astype(np.int32)), pa.array(away[a, b]), pa.array(reach)],
                        ["part", "pivot", "vec_id", "v", "dim", "far", "reach"],
                    )

        return go

    ask_schema = "part long, pivot long, vec_id long, v array<long>, dim int, far double, reach double"

    def searched(asks: DataFrame) -> DataFrame:
        """Queries meet the rows of their annulus; many queries of one annulus are spread over several copies of it."""
        asks = staged(asks, "topk-asks")
        crowd = asks.groupBy("part", "pivot", "dim").agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("copies"))
        many = asks.join(crowd, ["part", "pivot", "dim"]).withColumn("copy", F.pmod(F.xxhash64("vec_id"), "copies")).withColumn("ask", F.lit(True)).drop("copies")
        targets = blocks.withColumn("part", F.col("part").cast("long")).join(crowd, ["part", "pivot", "dim"]).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).withColumn("ask", F.lit(False)).withColumn("reach", F.lit(None).cast("double"))
        columns = ["part", "pivot", "dim", "copy", "ask", "vec_id", "v", "far", "reach"]
        both = many.select(*columns).union(targets.select(*columns))
        return both.groupBy("part", "pivot", "dim", "copy").applyInPandas(lambda frame: _search(frame, k), "query_id long, vec_id long, score long")

    if not index:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    seeds = staged(searched(queries.mapInArrow(visits(True), ask_schema)), "topk-seeds")
    floors = _ranked(seeds, k).groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n")).select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("floor")).cast("double").alias("floor"))
    rest = searched(queries.join(floors, "vec_id", "left").mapInArrow(visits(False), ask_schema))
    return _ranked(seeds.union(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH parts AS (
  SELECT vec_id, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS c, i
  FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, sum(q.c * x.c) AS score
  FROM parts q JOIN parts x ON q.i = x.i AND q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""


@query("op3_top_k", ORACLE)
def op3_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
