"""Operator 8: language identification by a bidirectional gated recurrent network over bytes.

The network is trained here in numpy by backpropagation through time.  A text is cut into windows of ``span`` bytes; in
each, one recurrence runs forward and one backward, every position gets a probability for each language, and the
document's probabilities are the mean over all its positions.  All windows of a slice advance together.

Cases: a null text, and one without any letter, gets ``und`` with score 0; so does every text if no labelled document
with a letter exists; repeated rows get equal results; a null doc_id is never held out and is used for learning if its
lang is not null.  Languages are the values of lang seen in the learning rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.textbytes import text_bytes, text_slices

PAD = 256


@dataclass
class Direction:
    """One gated recurrent layer: input rows, recurrent weights of both gates and of the candidate."""

    inputs: np.ndarray  # 257 x 3H: update gate, reset gate, candidate
    gates: np.ndarray  # H x 2H
    candidate: np.ndarray  # H x H

    def run(self, codes: np.ndarray, backward: bool, out: np.ndarray, keep: list | None = None) -> None:
        """Hidden states of all positions (T x B x H) into ``out``.  Gates are (1 + tanh) / 2; padding holds a state of zero."""
        steps, batch = codes.shape
        h_size = self.candidate.shape[0]
        h = np.zeros((batch, h_size), np.float32)
        padded = (codes == PAD).any(axis=1)
        for t in range(steps - 1, -1, -1) if backward else range(steps):
            x = self.inputs[codes[t]]
            g = h @ self.gates
            g += x[:, : 2 * h_size]
            np.tanh(g, out=g)
            g += 1.0
            g *= 0.5
            r = g[:, h_size:] * h
            n = r @ self.candidate
            n += x[:, 2 * h_size :]
            np.tanh(n, out=n)
            if keep is not None:
                keep.append((t, h.copy(), g, r, n))
            d = n - h
            d *= g[:, :h_size]
            h = h + d
            if padded[t]:
                h *= (codes[t] != PAD)[:, None]
            out[t] = h


#: A clear language has at least this many times the probability of an even share (0.3 with four languages).
OVER_CHANCE = 1.2


@dataclass
class LanguageModel:
    languages: list[str]
    forward: Direction
    backward: Direction
    head: np.ndarray  # 2H x L
    bias: np.ndarray
    span: int

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities of all positions, T x B x L."""
        steps, batch = codes.shape
        h_size = self.forward.candidate.shape[0]
        one, two = np.empty((steps, batch, h_size), np.float32), np.empty((steps, batch, h_size), np.float32)
        self.forward.run(codes, False, one)
        self.backward.run(codes, True, two)
        logits = one.reshape(-1, h_size) @ self.head[:h_size] + two.reshape(-1, h_size) @ self.head[h_size:] + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits.reshape(steps, batch, -1)

    def documents(self, data: np.ndarray, offsets: np.ndarray, together: int = 2048) -> np.ndarray:
        """Mean probabilities of each text; rows of empty texts are 0."""
        n = len(offsets) - 1
        sizes = np.diff(offsets)
        per = -(-sizes // self.span)
        owners = np.repeat(np.arange(n), per)
        begin = np.concatenate([[0], np.cumsum(per)])[:-1]
        starts = offsets[owners] + (np.arange(len(owners)) - begin[owners]) * self.span
        total = np.zeros((n, len(self.languages)))
        reach = np.arange(self.span)[:, None]
        for low in range(0, len(owners), together):
            own, at = owners[low : low + together], starts[low : low + together]
            places = at[None, :] + reach
            inside = places < offsets[own + 1][None, :]
            codes = np.where(inside, data[np.minimum(places, len(data) - 1)], PAD).astype(np.int64)
            found = self.positions(codes)
            if not inside.all():
                found *= inside[:, :, None]
            sums = found.sum(axis=0)
            np.add.at(total, own, sums)
        return total / np.maximum(sizes, 1)[:, None]


def _windows(data, offsets, span, count, seed) -> list[bytes]:
    """``count`` windows at random places of each text, drawn from the text itself: splits and batches change nothing."""
    out = []
    for low, high in zip(offsets[:-1], offsets[1:]):
        rng = np.random.default_rng([seed, *np.frombuffer(sha256(data[low:high].tobytes()).digest(), np.uint32).tolist()])
        for _ in range(count):
            at = int(rng.integers(low, max(low + 1, high - span + 1)))
            out.append(data[at : min(at + span, high)].tobytes())
    return out


def training_windows(docs: DataFrame, *, span: int, per_language: int, per_document: int, seed: int) -> list[tuple[bytes, str]]:
    """Windows of labelled documents: about ``per_language`` documents of each language, chosen by a hash over all rows."""
    known = docs.where("text is not null and lang is not null").where(F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in docs.where("text is not null and lang is not null").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(min(1.0, 1.2 * per_language / n)))])
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def cut(stream):
        for batch in stream:
            data, offsets = text_bytes(batch.column("text"))
            found = _windows(data, offsets, span, per_document, seed)
            langs = np.repeat(np.array(batch.column("lang").to_pylist(), object), per_document)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(langs, pa.string())], ["piece", "lang"])

    rows = known.where(place < share[F.col("lang")]).select("text", "lang").mapInArrow(cut, "piece binary, lang string").collect()
    return sorted((bytes(r["piece"]), r["lang"]) for r in rows)


def fit_language(pieces: list[tuple[bytes, str]], *, span: int = 48, hidden: int = 8, steps: int = 260, batch: int = 256, rate: float = 0.02, seed: int = 3) -> LanguageModel | None:
    """Backpropagation through time with Adam over balanced batches of windows."""
    if not pieces:
        return None
    languages = sorted({lang for _, lang in pieces})
    rng = np.random.default_rng(seed)
    codes = np.full((span, len(pieces)), PAD, np.int64)
    for k, (piece, _) in enumerate(pieces):
        codes[: len(piece), k] = np.frombuffer(piece, np.uint8)[:span]
    index = {lang: k for k, lang in enumerate(languages)}
    target = np.array([index[lang] for _, lang in pieces])
    groups = [np.flatnonzero(target == k) for k in range(len(languages))]

    def direction() -> Direction:
        inputs = rng.normal(0, 0.3, (257, 3 * hidden)).astype(np.float32)
        inputs[:, : 2 * hidden] -= 0.3
        return Direction(inputs, rng.normal(0, 0.2, (hidden, 2 * hidden)).astype(np.float32), rng.normal(0, 0.3, (hidden, hidden)).astype(np.float32))

    model = LanguageModel(languages, direction(), direction(), rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32), span)
    values = [model.forward.inputs, model.forward.gates, model.forward.candidate, model.backward.inputs, model.backward.gates, model.backward.candidate, model.head, model.bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    each = max(1, batch // len(languages))
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(g, each) for g in groups])
        slopes = _slopes(model, codes[:, chosen], target[chosen])
        speed = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k, (value, slope) in enumerate(zip(values, slopes)):
            np.clip(slope, -1, 1, out=slope)
            first[k] += 0.1 * (slope - first[k])
            second[k] += 0.01 * (slope**2 - second[k])
            value -= speed * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return model


def _slopes(model: LanguageModel, codes: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over all positions."""
    steps, batch = codes.shape
    hidden = model.forward.candidate.shape[0]
    states, kept = [], []
    for layer, backward in ((model.forward, False), (model.backward, True)):
        out, keep = np.empty((steps, batch, hidden), np.float32), []
        layer.run(codes, backward, out, keep)
        states.append(out)
        kept.append(keep)
    both = np.concatenate(states, axis=2)
    logits = both @ model.head + model.bias
    logits -= logits.max(axis=2, keepdims=True)
    error = np.exp(logits)
    error /= error.sum(axis=2, keepdims=True)
    error[:, np.arange(batch), target] -= 1
    inside = codes != PAD
    error *= inside[:, :, None] / max(1, inside.sum())
    head = both.reshape(-1, 2 * hidden).T @ error.reshape(steps * batch, -1)
    bias = error.sum(axis=(0, 1))
    into = error @ model.head.T
    slopes = []
    for k, layer in enumerate((model.forward, model.backward)):
        inputs, gates, candidate = np.zeros_like(layer.inputs), np.zeros_like(layer.gates), np.zeros_like(layer.candidate)
        carried = np.zeros((batch, hidden), np.float32)
        for t, h, g, r, n in reversed(kept[k]):
            d = (carried + into[t, :, k * hidden : (k + 1) * hidden]) * inside[t][:, None]
            z, reset = g[:, :hidden], g[:, hidden:]
            dn = d * z * (1 - n * n)
            dr = dn @ layer.candidate.T
            dz = d * (n - h) * 2 * z * (1 - z)
            dreset = dr * h * 2 * reset * (1 - reset)
            dg = np.concatenate([dz, dreset], axis=1)
            candidate += r.T @ dn
            gates += h.T @ dg
            np.add.at(inputs, codes[t], np.concatenate([dg, dn], axis=1))
            carried = d * (1 - z) + dr * reset + dg @ layer.gates.T
        slopes += [inputs, gates, candidate]
    return [*slopes, head.astype(np.float32), bias.astype(np.float32)]


def predict_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; other columns are dropped."""
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(letter, F.col("text")).alias("text"), letter.alias("letter"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    def batches(stream):
        names = np.array(model.languages, object)
        for batch in stream:
            for own, data, offsets in text_slices(batch):
                found = model.documents(data, offsets)
                best = found.argmax(axis=1)
                letters = np.asarray(own.column("letter").to_numpy(zero_copy_only=False), bool)
                langs = np.where(letters, names[best], "und")
                score = np.where(letters, np.clip(found[np.arange(len(best)), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), pa.array(langs, pa.string()), pa.array(score.astype(np.float64))], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(batches, "doc_id long, lang_pred string, score double")


def recognised(docs: DataFrame, model: LanguageModel | None, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is found with a score of at least ``least``, or of OVER_CHANCE
    times an even share where many languages make that less; without a model, all that have a letter."""
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.where(letter)
    least = min(least, OVER_CHANCE / len(model.languages))

    def batches(stream):
        for batch in stream:
            for own, data, offsets in text_slices(batch):
                yield own.filter(pa.array(model.documents(data, offsets).max(axis=1) >= least))

    return docs.where(letter).mapInArrow(batches, docs.schema)


def held_out(doc_id="doc_id"):
    """Rows that the learning leaves out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learned_language(docs: DataFrame, *, span: int = 48, per_language: int = 400, per_document: int = 4, seed: int = 3) -> LanguageModel | None:
    """Fit on a bounded sample (about ``per_language`` documents of each language) of the rows that are not held out."""
    known = docs.select("doc_id", "text", "lang").where(~held_out())
    return fit_language(training_windows(known, span=span, per_language=per_language, per_document=per_document, seed=seed), span=span, seed=seed)


@query("op8_language")
def op8_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = predict_language(docs, learned_language(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
