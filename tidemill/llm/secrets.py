"""Operator 10: secret scan by base rules and a character convolutional network.

Candidates are all runs of at least eight token characters, wherever they stand, but those wholly inside base findings.  The
network reads each candidate with the text around it, a long one in overlapping windows that cover all of it, of which the
highest probability counts; it learns from labelled findings: windows with base
findings count as secrets, candidates without do not.  In half of the examples the text before the candidate is blanked, so that the shape
of a value counts by itself.  A bounded choice of findings gives first weights.  They are then moved by the gradients of all
findings of all rows, which tasks sum up, in a step for each of STEPS parts of the texts.  A fifth of all findings, by hash,
is kept from both; on the whole of it a logistic calibration and a threshold that keeps a wanted recall are fitted.  Base spans always
stay; the network only adds spans.

Spans count code points, ends are exclusive.  Cases: a null or empty text has no spans; findings of one kind don't
overlap, those of different kinds may; repeated rows get equal results; without labelled findings of both sorts nothing
is added; extra columns are dropped by the scan and kept by ``redact_secrets``.
"""

from __future__ import annotations

import hashlib
import logging
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.staging import staged
from tidemill.llm.textbytes import byte_table, code_points, mix, owner, runs, text_slices

KINDS = ("assign", "access", "hex", "model")
# The three base patterns and their least lengths.
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

HEX = byte_table("0-9 a-f")
TOKEN = byte_table("0-9 a-z A-Z + / _ = -")
TOKEN[ord("+")] = True
TOKEN[128:] = False
#: A longer candidate is read in windows of LONGEST bytes, STEP apart.
LONGEST, STEP = 32, 16
BEFORE, AFTER = 20, 4
WIDTH = BEFORE + LONGEST + AFTER
#: Steps over all texts, each on a part of them, and their length; findings beyond MARGIN on their side have no slope.
STEPS, RATE, MARGIN = 4, 0.05, 5.0
#: Logits of held findings are counted in bins, GRID of them for one unit, up to 40 on both sides.
GRID = 64
WEIGHTS = ("embed", "filters", "bias", "head")


def base_findings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and kinds (numbers into KINDS) of all base findings, in bytes."""
    starts, ends, kinds = [], [], []
    signs = np.flatnonzero((data == 61) | (data == 58))
    assign, access = re.compile(ASSIGN, re.IGNORECASE), re.compile(ACCESS)
    raw = data.tobytes()
    for k in np.unique(owner(signs, offsets)):
        for m in assign.finditer(raw, int(offsets[k]), int(offsets[k + 1])):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                starts.append(m.start())
                ends.append(m.end())
                kinds.append(0)
    if b"AKIA" in raw:
        places, at = [], raw.find(b"AKIA")
        while at >= 0:
            places.append(at)
            at = raw.find(b"AKIA", at + 1)
        for k in np.unique(owner(np.array(places), offsets)):
            for m in access.finditer(raw, int(offsets[k]), int(offsets[k + 1])):
                if m.end() - m.start() >= LEAST["access"]:
                    starts.append(m.start())
                    ends.append(m.end())
                    kinds.append(1)
    a, b = runs(HEX[data], offsets)
    long = b - a >= LEAST["hex"]
    starts, ends = np.concatenate([np.array(starts, np.int64), a[long]]), np.concatenate([np.array(ends, np.int64), b[long]])
    return starts, ends, np.concatenate([np.array(kinds, np.int64), np.full(long.sum(), 2)])


def candidates(data: np.ndarray, offsets: np.ndarray, least: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Runs of at least ``least`` token characters."""
    a, b = runs(TOKEN[data], offsets)
    long = b - a >= least
    return a[long], b[long]


def lettered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, plain: int = 20) -> np.ndarray:
    """Which candidates are shorter than ``plain`` and without a digit, as words are."""
    digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
    return (digits[ends] == digits[starts]) & (ends - starts < plain)


def stretches(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of at most LONGEST bytes that cover each candidate: candidate numbers, starts and ends."""
    count = 1 + np.maximum(0, -(-(ends - starts - LONGEST) // STEP))
    of = np.repeat(np.arange(len(starts)), count)
    begin = starts[of] + (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * STEP
    begin = np.minimum(begin, np.maximum(ends[of] - LONGEST, starts[of]))
    return of, begin, np.minimum(begin + LONGEST, ends[of])


def windows(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of each stretch with those around it; 0 outside the text."""
    of = owner(starts, offsets)
    low, high = offsets[of], np.minimum(offsets[of + 1], ends + AFTER)
    place = starts[:, None] - BEFORE + np.arange(WIDTH)[None, :]
    inside = (place >= low[:, None]) & (place < high[:, None])
    return np.where(inside, data[np.clip(place, 0, max(len(data) - 1, 0))], 0).astype(np.uint8)


@dataclass
class SecretModel:
    """Byte embeddings, one convolution, maxima over the candidate and over all, a linear head; calibrated."""

    embed: np.ndarray  # 256 x E
    filters: np.ndarray  # K*E x C
    bias: np.ndarray
    head: np.ndarray  # 2C
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.1
    precision: float = 0.0  # of held findings at the threshold
    recall: float = 0.0
    taps: int = 5

    def _convolve(self, codes: np.ndarray):
        x = self.embed[codes]
        n, width, e = x.shape
        steps = width - self.taps + 1
        view = np.lib.stride_tricks.sliding_window_view(x, self.taps, axis=1).transpose(0, 1, 3, 2).reshape(n * steps, self.taps * e)
        return view, np.maximum((view @ self.filters + self.bias).reshape(n, steps, -1), 0)

    def logits(self, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
        view, y = self._convolve(codes)
        inner = y[:, BEFORE:]
        pooled = np.concatenate([inner.max(axis=1), y.mean(axis=1)], axis=1)
        if keep is not None:
            keep += [view, y, inner.argmax(axis=1) + BEFORE, pooled]
        return pooled @ self.head + self.offset

    def slopes(self, codes: np.ndarray, error: np.ndarray, keep: list) -> dict[str, np.ndarray]:
        """The slopes of all weights, from those of the logits and what ``logits`` kept."""
        view, y, peak, pooled = keep
        c, e = y.shape[2], self.embed.shape[1]
        slopes = {"head": pooled.T @ error}
        into = error[:, None] * self.head[None, :]
        dy = np.repeat(into[:, None, c:] / y.shape[1], y.shape[1], axis=1)
        rows, channels = np.indices((len(codes), c))
        np.add.at(dy, (rows, peak, channels), into[:, :c])
        dy = (dy * (y > 0)).reshape(-1, c)
        slopes["filters"], slopes["bias"] = view.T @ dy, dy.sum(axis=0)
        dview = (dy @ self.filters.T).reshape(len(codes), y.shape[1], self.taps, e)
        dembed = np.zeros_like(self.embed)
        for k in range(self.taps):
            np.add.at(dembed, codes[:, k : k + y.shape[1]], dview[:, :, k])
        slopes["embed"] = dembed
        return slopes

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_looked_up"}

    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the convolution makes of each pair of bytes at its first four taps, and of a byte at the last one with the bias."""
        own = self.embed, self.filters, self.bias
        made = self.__dict__.get("_looked_up")
        if made is None or any(a is not b for a, b in zip(made[0], own)):
            e = self.embed.shape[1]
            taps = [(self.embed @ self.filters[k * e : (k + 1) * e]).astype(np.float32) for k in range(5)]
            pairs = [(taps[k][:, None, :] + taps[k + 1][None, :, :]).reshape(1 << 16, -1) for k in (0, 2)]
            made = self._looked_up = own, (*pairs, taps[4] + self.bias.astype(np.float32))
        return made[1]

    def all_logits(self, codes: np.ndarray, together: int = 64) -> np.ndarray:
        """``logits`` in single precision by look-up, few windows at a time so that they stay in the processor's cache."""
        first, second, last = self._tables()
        parts = []
        for low in range(0, len(codes), together):
            own = codes[low : low + together]
            pair = own[:, :-1].astype(np.int32) << 8 | own[:, 1:]
            y = first.take(pair[:, : WIDTH - 4], axis=0)
            y += second.take(pair[:, 2 : WIDTH - 2], axis=0)
            y += last.take(own[:, 4:], axis=0)
            np.maximum(y, 0, out=y)
            parts.append(np.concatenate([y[:, BEFORE:].max(axis=1), y.mean(axis=1)], axis=1) @ self.head + self.offset)
        return np.concatenate(parts).astype(np.float64) if parts else np.empty(0)

    def odds(self, z: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of logits."""
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -40, 40)))

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return self.odds(self.all_logits(codes))


def fit_secrets(codes: np.ndarray, target: np.ndarray, *, recall: float = 0.95, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 5) -> SecretModel | None:
    """Train on four fifths of the findings; calibrate and choose the threshold on the others, a fifth of each sort."""
    if len(target) < 10 or target.min() == target.max():
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(target))
    codes, target = codes[order], target[order].astype(np.float64)
    e, c, taps = 8, 16, 5
    model = SecretModel(rng.normal(0, 0.3, (256, e)), rng.normal(0, 0.2, (taps * e, c)), np.zeros(c), rng.normal(0, 0.3, 2 * c), 0.0, taps=taps)
    model.embed[0] = 0
    sorts = [np.flatnonzero(target == y) for y in (0, 1)]
    cuts = [max(1, len(s) // 5) for s in sorts]
    out = np.concatenate([s[:cut] for s, cut in zip(sorts, cuts)])
    own = np.sort(np.concatenate([s[cut:] if len(s) > 1 else s for s, cut in zip(sorts, cuts)]))  # a single finding serves for both
    held, held_target, codes, target = codes[out], target[out], codes[own], target[own]
    values = WEIGHTS
    first, second, step = {v: 0.0 for v in values}, {v: 0.0 for v in values}, 0
    weight = np.where(target > 0, 0.5 / max(target.mean(), 1e-6), 0.5 / max(1 - target.mean(), 1e-6))
    for _ in range(epochs):
        for low in range(0, len(target), batch):
            chosen = rng.permutation(len(target))[:batch]
            own = codes[chosen].copy()
            blank = rng.random(len(own)) < 0.5
            own[blank, :BEFORE] = 32
            keep: list = []
            z = model.logits(own, keep)
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target[chosen]) * weight[chosen] / len(own)
            slopes = model.slopes(own, error, keep)
            step += 1
            model.offset -= rate * float(error.sum()) * 10
            for v in values:
                first[v] = 0.9 * first[v] + 0.1 * slopes[v]
                second[v] = 0.99 * second[v] + 0.01 * slopes[v] ** 2
                setattr(model, v, getattr(model, v) - rate * (first[v] / (1 - 0.9**step)) / (np.sqrt(second[v] / (1 - 0.99**step)) + 1e-8))
    for v in values:  # single precision from here on: words are candidates, too
        setattr(model, v, getattr(model, v).astype(np.float32))
    z = model.logits(held).astype(np.float64)
    model.slope, model.shift = calibration(z, held_target)
    model.threshold, model.precision, model.recall = recall_threshold(model.probabilities(held), held_target, recall)
    logging.getLogger(__name__).info("secret network: threshold %.4f, precision %.3f, recall %.3f of held findings", model.threshold, model.precision, model.recall)
    return model


def calibration(z: np.ndarray, target: np.ndarray, count: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and shift of logits by Newton's method, with a weak prior; ``count``: how many findings each stands for."""
    a, b = 1.0, 0.0
    share = np.full(len(z), 1 / len(z)) if count is None else count / count.sum()
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        off, w = share * (p - target), share * p * (1 - p)
        g = np.array([(off * z).sum() + 1e-3 * (a - 1), off.sum() + 1e-3 * b])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        d = np.linalg.solve(h, g)
        a, b = a - np.clip(d[0], -1, 1), b - np.clip(d[1], -1, 1)
    return float(a), float(b)


def recall_threshold(p: np.ndarray, target: np.ndarray, recall: float, even: float = 0.5, count: np.ndarray | None = None) -> tuple[float, float, float]:
    """Of the thresholds that find the wanted share of the secrets, the most precise, ties to the smallest; with its
    precision and recall.  All probabilities are tried, and even odds between them; the smallest one finds all secrets, so
    there is a threshold whenever there are some."""
    count = np.ones(len(p), np.int64) if count is None else count
    secret, total = target > 0, int(count[target > 0].sum())
    best, chosen = (-1.0, 0.0), (1.1, 0.0, 0.0)
    for t in np.unique(np.append(p, even)) if total else ():
        hit = p >= t
        found = int(count[hit & secret].sum())
        precision = found / max(1, int(count[hit].sum()))
        if found >= recall * total and (precision, -t) > best:
            best, chosen = (precision, -t), (float(t), precision, found / total)
    return chosen


def _covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of the bytes before each place lie in a span."""
    steps = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.concatenate([[0], np.cumsum(np.cumsum(steps)[:size] > 0)])


def highest(model: SecretModel, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, together: int = 4096) -> np.ndarray:
    """The highest probability of each candidate's windows."""
    best = np.zeros(len(starts))
    of, a, b = stretches(starts, ends)
    for low in range(0, len(of), together):
        part = slice(low, low + together)
        np.maximum.at(best, of[part], model.probabilities(windows(data, offsets, a[part], b[part])))
    return best


def _sorted_stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and sorts of all stretches of candidates: 2 secret, 0 word, 1 other, -1 of no sort."""
    bs, be, _ = base_findings(data, offsets)
    cs, ce = candidates(data, offsets)
    of, a, b = stretches(cs, ce)
    covered = _covered(len(data), bs, be)
    secret = 2 * (covered[b] - covered[a]) >= b - a
    y = np.where(secret, 2, np.where(lettered(data, cs, ce)[of], 0, 1))
    y[~secret & (covered[ce] > covered[cs])[of]] = -1
    return a, b, y


def labelled_findings(docs: DataFrame, *, most: int = 6000, seed: int = 11, together: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Windows of candidates with 1 if base findings hold half of them or more and 0 without any: of each sort (secrets,
    words, other candidates) the ``most`` distinct ones with the smallest hash over all candidates of all rows, of which each task keeps its own.  What else a candidate
    with a base finding holds is of no sort."""

    def batches(stream):
        kept = [(np.empty(0, np.uint64), np.empty((0, WIDTH), np.uint8))] * 3
        for batch in stream:
            for _, data, offsets in text_slices(batch):
                a, b, y = _sorted_stretches(data, offsets)
                for k in range(3):
                    own = np.flatnonzero(y == k)
                    for low in range(0, len(own), together):
                        part = own[low : low + together]
                        kept[k] = _smallest(*kept[k], windows(data, offsets, a[part], b[part]), most, seed)
        for k, (place, codes) in enumerate(kept):
            values = [pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(np.full(len(codes), k, np.int32)), pa.array((place >> np.uint64(1)).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(values, ["piece", "y", "place"])

    found = staged(docs.select("text").mapInArrow(batches, "piece binary, y int, place long"), "secret-findings")
    kept = [found.where(F.col("y") == y).distinct().orderBy("place", "piece").limit(most).collect() for y in range(3)]
    rows = [r for part in kept for r in part]
    codes = np.stack([np.frombuffer(bytes(r["piece"]), np.uint8) for r in rows]) if rows else np.empty((0, WIDTH), np.uint8)
    return codes, np.array([r["y"] == 2 for r in rows], np.int64)


def _draw(codes: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each window."""
    own = np.full(len(codes), seed, np.uint64)
    for part in np.ascontiguousarray(codes).view(np.uint64).T:
        own = mix(own * np.uint64(0x9E3779B97F4A7C15) + part)
    return own


def held_out(codes: np.ndarray) -> np.ndarray:
    """Which windows weights never see: equal ones go together, whatever row they are in."""
    return _draw(codes, 23) % np.uint64(5) == 0


def _summed(docs: DataFrame, add, cells: int, together: int = 4096) -> np.ndarray:
    """``add(totals, codes, secret)`` over the windows of all findings of all rows, in each task, and the totals of the tasks added up."""

    def batches(stream):
        totals = np.zeros(cells)
        for batch in stream:
            for _, data, offsets in text_slices(batch):
                a, b, y = _sorted_stretches(data, offsets)
                own = np.flatnonzero(y >= 0)
                for low in range(0, len(own), together):
                    part = own[low : low + together]
                    add(totals, windows(data, offsets, a[part], b[part]), y[part] == 2)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals[at])], ["cell", "total"])

    rows = docs.select("text").mapInArrow(batches, "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(cells)
    out[[r["cell"] for r in rows]] = [r["total"] for r in rows]
    return out


def _moved(docs: DataFrame, model: SecretModel) -> None:
    """One step along the slopes of all findings of ``docs`` that are not held out; both sorts weigh the same."""
    size = sum(getattr(model, v).size for v in WEIGHTS) + 1

    def add(totals, codes, secret):
        seen = ~held_out(codes)
        codes, secret = codes[seen], secret[seen]
        totals[-2:] += [(~secret).sum(), secret.sum()]
        near = np.where(secret, 1, -1) * model.all_logits(codes) < MARGIN
        for sort in (0, 1):
            own = codes[near & (secret == sort)]
            for low in range(0, len(own), 512):
                some, keep = own[low : low + 512], []
                error = 1 / (1 + np.exp(-np.clip(model.logits(some, keep), -40, 40))) - sort
                slopes = model.slopes(some, error, keep)
                totals[sort * size : (sort + 1) * size] += np.concatenate([*(slopes[v].ravel() for v in WEIGHTS), [error.sum()]])

    totals = _summed(docs, add, 2 * size + 2)
    step = sum(0.5 * totals[sort * size : (sort + 1) * size] / max(totals[sort - 2], 1) for sort in (0, 1))
    step *= RATE / max(1.0, float(np.linalg.norm(step)))
    for v in WEIGHTS:
        own, step = np.split(step, [getattr(model, v).size])
        setattr(model, v, (getattr(model, v) - own.reshape(getattr(model, v).shape)).astype(np.float32))
    model.offset -= float(step[0])


def held_logits(docs: DataFrame, model: SecretModel, every: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits in steps of 1 / GRID, whether secret, and how many held findings (or ``every`` finding) of all rows have them."""
    bins = 80 * GRID + 1

    def add(totals, codes, secret):
        own = slice(None) if every else held_out(codes)
        z = np.clip(np.floor(model.all_logits(codes[own]) * GRID), -40 * GRID, 40 * GRID).astype(np.int64) + 40 * GRID
        totals += np.bincount(z + bins * secret[own], minlength=2 * bins)

    count = _summed(docs, add, 2 * bins).astype(np.int64)
    at = np.flatnonzero(count)
    return (at % bins) / GRID - 40, (at >= bins).astype(np.int64), count[at]


def _smallest(place: np.ndarray, kept: np.ndarray, codes: np.ndarray, most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` distinct windows with the smallest hashes of those kept so far and new ones."""
    own = _draw(codes, seed)
    if len(place) == most:
        small = own < place[-1]
        own, codes = own[small], codes[small]
    if not len(own):
        return place, kept
    place, first = np.unique(np.concatenate([place, own]), return_index=True)
    return place[:most], np.concatenate([kept, codes])[first[:most]]


def find_secrets(data: np.ndarray, offsets: np.ndarray, model: SecretModel | None):
    """Starts, ends and kinds in bytes, base findings and added ones, sorted by start and kind."""
    starts, ends, kinds = base_findings(data, offsets)
    if model is not None:
        a, b = candidates(data, offsets)
        covered = _covered(len(data), starts, ends)
        beyond = covered[b] - covered[a] < b - a
        a, b = a[beyond], b[beyond]
        hit = highest(model, data, offsets, a, b) >= model.threshold
        starts, ends, kinds = np.concatenate([starts, a[hit]]), np.concatenate([ends, b[hit]]), np.concatenate([kinds, np.full(hit.sum(), 3)])
    order = np.lexsort((kinds, starts))
    return starts[order], ends[order], kinds[order]


def learned_secrets(docs: DataFrame, *, recall: float = 0.95, **options) -> SecretModel | None:
    """First weights from a bounded choice, then steps, calibration and threshold from the findings of all rows."""
    codes, target = labelled_findings(docs, **options)
    seen = ~held_out(codes)
    if seen.sum() < 10 or target[seen].min() == target[seen].max():
        seen[:] = True
    model = fit_secrets(codes[seen], target[seen], recall=recall)
    if model is None:
        return None
    part = F.pmod(F.xxhash64("text"), F.lit(STEPS))
    for k in range(STEPS):
        _moved(docs.where(part == k), model)
    z, secret, count = held_logits(docs, model)
    if len(np.unique(secret)) < 2:  # too few for a fifth of each sort
        z, secret, count = held_logits(docs, model, every=True)
    # a bin stands for its lower end, so that a threshold there takes the whole bin
    model.slope, model.shift = calibration(z, secret, count)
    model.threshold, model.precision, model.recall = recall_threshold(model.odds(z if model.slope > 0 else z + 1 / GRID), secret, recall, count=count)
    logging.getLogger(__name__).info("secret network: threshold %.4f, precision %.3f, recall %.3f of held findings", model.threshold, model.precision, model.recall)
    return model


def scan_secrets(docs: DataFrame, model: SecretModel | None) -> DataFrame:
    """``doc_id``, the counts of base findings, their digest and all spans, for every row."""

    def batches(stream):
        for batch in stream:
            for own, data, offsets in text_slices(batch):
                n = own.num_rows
                starts, ends, kinds = find_secrets(data, offsets, model)
                of = owner(starts, offsets)
                points = code_points(data)
                low, high = points[starts] - points[offsets[of]], points[ends] - points[offsets[of]]
                counts = [np.bincount(of[kinds == k], minlength=n) for k in range(3)]
                base: list[list[str]] = [[] for _ in range(n)]
                spans: list[list[str]] = [[] for _ in range(n)]
                for d, k, a, b in zip(of.tolist(), kinds.tolist(), low.tolist(), high.tolist()):
                    said = f"{KINDS[k]}:{a}:{b}"
                    spans[d].append(said)
                    if k < 3:
                        base[d].append(said)
                digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in base]
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), *map(pa.array, counts), pa.array(digest, pa.string()), pa.array([",".join(x) for x in spans], pa.string())],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(batches, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_secrets(docs: DataFrame, model: SecretModel | None, mark: str = "[secret]") -> DataFrame:
    """All rows and columns, each span of the text replaced by ``mark`` (touching spans by one); ``n_chars``, if there, follows."""
    out = mark.encode()

    def batches(stream):
        for batch in stream:
            for own, data, offsets in text_slices(batch):
                texts = own.column("text").to_pylist()
                starts, ends, _ = find_secrets(data, offsets, model)
                of = owner(starts, offsets)
                for k in np.unique(of):
                    raw, at, parts = data[offsets[k] : offsets[k + 1]].tobytes(), 0, []
                    for a, b in zip(starts[of == k] - offsets[k], ends[of == k] - offsets[k]):
                        if a >= at:
                            parts += [raw[at:a], out]
                        at = max(at, b)
                    texts[k] = b"".join([*parts, raw[at:]]).decode()
                yield own.set_column(own.schema.get_field_index("text"), own.schema.field("text"), pa.array(texts, own.schema.field("text").type))

    found = docs.mapInArrow(batches, docs.schema)
    return found.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


@query("op10_secrets")
def op10_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return scan_secrets(docs, learned_secrets(docs))
