"""Operator 1: document quality by random Fourier features, ridge regression and isotonic calibration.

Each text becomes a short vector of statistics (shares of character classes, word and line repetition).  Random Fourier
features approximate a Gaussian kernel over them.  Ridge weights come from normal equations that are summed partition by
partition; a monotone (isotonic) map fitted on rows that the weights have not seen turns raw scores into probabilities.

Cases: a null or empty text has statistics of zero and gets a score like any other; repeated rows get equal scores; a
null doc_id is never held out and never trained on; with no labelled row of each value the score is the mean label, or 0.5
without any label; a label counts as 1 if the mean of the labels of its doc_id is at least a half.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.staging import staged
from tidemill.llm.textbytes import SpanHashes, repeat_index, runs, text_slices, words

STATISTICS = 20
PREDICTED = 0.3


def _classes() -> np.ndarray:
    """0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 usual punctuation, 7 odd symbol, 8 long character, 9 its tail."""
    of = np.zeros(256, np.uint8)
    of[97:123], of[65:91], of[48:58] = 1, 2, 3
    of[[32, 9]], of[[10, 13]] = 4, 5
    of[list(b".,;:'\"-()?")] = 6
    of[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = 7
    of[192:], of[128:192] = 8, 9
    return of


CLASSES = _classes()


def _distinct(owners: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each text."""
    order = np.lexsort((hashes, owners))
    a, b = owners[order], hashes[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return np.bincount(a[new], minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS numbers for each text, whatever its length."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    owners = np.repeat(np.arange(n), sizes)
    of = CLASSES[data]
    counts = np.bincount(owners * 10 + of, minlength=n * 10).reshape(n, 10).astype(np.float64)
    chars = np.maximum(sizes - counts[:, 9], 1)
    starts, ends, hashes, firsts = words(data, offsets)
    n_words = np.diff(firsts)
    some = np.maximum(n_words, 1)
    word_of = repeat_index(firsts)
    length = np.bincount(word_of, weights=ends - starts, minlength=n)
    square = np.bincount(word_of, weights=np.minimum(ends - starts, 200) ** 2.0, minlength=n)
    shouted = np.bincount(word_of, weights=(of[starts] == 2) & (of[ends - 1] == 2), minlength=n)
    same = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (word_of[1:] == word_of[:-1])
    line_starts, line_ends = runs(of != 5, offsets)
    line_of = np.searchsorted(offsets, line_starts, "right") - 1
    lines = np.bincount(line_of, minlength=n)
    line_hashes = SpanHashes(data).of(line_starts, line_ends)
    odd = of == 7
    odd_runs = np.bincount(np.searchsorted(offsets, runs(odd, offsets)[0], "right") - 1, minlength=n)
    pipes = np.bincount(owners[data == 124], minlength=n) if len(data) else np.zeros(n)
    letters = counts[:, 1] + counts[:, 2] + counts[:, 8]
    mean = length / some
    out = [
        np.log1p(sizes), np.log1p(n_words), mean, np.sqrt(np.maximum(square / some - mean**2, 0)),
        counts[:, 1] / chars, counts[:, 2] / chars, counts[:, 3] / chars, counts[:, 4] / chars, counts[:, 5] / chars,
        counts[:, 6] / chars, counts[:, 7] / chars, counts[:, 8] / chars, counts[:, 0] / chars,
        _distinct(word_of, hashes, n) / some, np.bincount(word_of, weights=same, minlength=n) / some,
        np.where(lines > 0, _distinct(line_of, line_hashes, n) / np.maximum(lines, 1), 1), odd_runs / some, pipes / some,
        shouted / some, letters / chars,
    ]
    return np.stack(out, axis=1).astype(np.float32)


def document_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, stats array<float>`` of every row; the text is read once and goes no further."""

    def batches(stream):
        for batch in stream:
            for rows, data, offsets in text_slices(batch):
                found = statistics(data, offsets)
                values = pa.array(found.ravel())
                places = pa.array(np.arange(0, found.size + 1, STATISTICS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.ListArray.from_arrays(places, values)], ["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(batches, "doc_id long, stats array<float>")


@dataclass
class QualityModel:
    """Everything a task needs for a score: a few hundred kilobytes whatever the corpus."""

    centre: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.centre, self.scale, self.frequencies, self.phases)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.levels)


def fourier(stats, centre, scale, frequencies, phases) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel, a constant last."""
    z = np.clip((stats - centre) / scale, -8, 8)
    waves = np.cos(z @ frequencies + phases) * np.sqrt(2 / len(phases))
    return np.concatenate([waves, np.ones((len(z), 1))], axis=1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and levels of the best non-decreasing fit, shrunk a little from 0 and 1."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    blocks: list[list[float]] = []  # sum, count, sum of x
    for a, b in zip(x, y):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, c, t = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += c
            blocks[-1][2] += t
    found = np.array(blocks)
    return found[:, 2] / found[:, 1], (found[:, 0] + 0.5 * y.mean()) / (found[:, 1] + 0.5)


def _stats_matrix(column) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), STATISTICS)


def _partition_sums(rows: DataFrame, features) -> tuple[np.ndarray, np.ndarray, float]:
    """Sums of z z', z y and the row count, one partial result for each partition."""

    def batches(stream):
        a = b = None
        count = 0.0
        for batch in stream:
            z, y = features(_stats_matrix(batch.column("stats"))), np.asarray(batch.column("y"), np.float64)
            if a is None:
                a, b = np.zeros((z.shape[1], z.shape[1])), np.zeros(z.shape[1])
            a += z.T @ z
            b += z.T @ y
            count += len(y)
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([b.tobytes()]), pa.array([count])], ["a", "b", "n"])

    a = b = 0.0
    count = 0.0
    for row in rows.mapInArrow(batches, "a binary, b binary, n double").collect():
        b = b + np.frombuffer(row.b)
        a = a + np.frombuffer(row.a).reshape(len(b), len(b))
        count += row.n
    return a, b, count


def fit_quality(stats: DataFrame, labels: DataFrame, *, waves: int = 256, ridge: float = 1e-3, width: float = 0.35, max_rows: int = 60_000, parts: int = 12, seed: int = 7) -> QualityModel:
    """Fit on labelled rows (``doc_id, y``), at most about ``max_rows`` of them, chosen by a hash of the id.

    A fifth of the rows is kept from the weights for the calibration.  ``parts`` partial sums reach the driver.
    """
    total = labels.count()
    share = min(1.0, max_rows / max(total, 1))
    pick = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000))
    chosen = labels.where(pick < F.lit(int(share * 1_000_000)))
    rows = staged(chosen.join(stats, "doc_id").select("stats", F.col("y").cast("double").alias("y"), F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(5)).alias("fold")).repartition(parts), "quality-rows")
    learn = rows.where("fold != 0")
    a, b, n = _partition_sums(learn, lambda x: np.concatenate([x, np.ones((len(x), 1))], axis=1))
    rng = np.random.default_rng(seed)
    frequencies, phases = rng.normal(0, width, (STATISTICS, waves)), rng.uniform(0, 2 * np.pi, waves)
    if n < 2:
        mean = labels.agg(F.avg("y")).first()[0]
        flat = 0.5 if mean is None else float(mean)
        return QualityModel(np.zeros(STATISTICS), np.ones(STATISTICS), frequencies, phases, np.zeros(waves + 1), np.array([0.0]), np.array([flat]))
    centre = a[-1, :-1] / n
    scale = np.sqrt(np.maximum(np.diag(a)[:-1] / n - centre**2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    a, b, n = _partition_sums(learn, lambda x: fourier(x, centre, scale, frequencies, phases))
    weights = np.linalg.solve(a + ridge * n * np.eye(len(b)), b)
    model = QualityModel(centre, scale, frequencies, phases, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    held = rows.where("fold = 0").toPandas()
    if len(held) == 0:
        return model
    held = held.sort_values("y")
    model.knots, model.levels = isotonic(model.raw(np.stack(held["stats"].to_numpy()).astype(np.float64)), held["y"].to_numpy())
    return model


def score_quality(stats: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score``."""

    def batches(stream):
        for batch in stream:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(model.score(_stats_matrix(batch.column("stats"))), 0.0, 1.0))], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(batches, "doc_id long, score double")


def document_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out of the training.
    """
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    held = F.coalesce(remainder == 0, F.lit(False))
    stats = staged(document_statistics(docs), "quality-stats")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where("doc_id is not null and quality is not null").where(~held).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    model = fit_quality(stats, known)
    return score_quality(stats, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted"))


@query("op1_quality")
def op1_quality(spark, sf_dir):
    return document_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
