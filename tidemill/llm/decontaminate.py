"""Operator 7: benchmark decontamination by greedy string tiling.

Documents and benchmark items are word sequences.  A document becomes a candidate for an item by sharing a run of five
words with it (an item of fewer words: all of them).  The longest common runs of unmarked words, found with Karp-Rabin
hashes, are marked as tiles again and again until none of at least five words is left, so passages that were cut up and
put in another order still cover the item.  A document is contaminated by an item if its tiles cover at least half of the
item's words.

The benchmark goes to every task while its words fit a bound; a larger one is joined by its seeds.

Cases: null or empty texts and items match nothing; repeated documents or items give a row for each; words compare in
lower case (ASCII); of equally long tiles, the one first in the item and then in the document is marked; extra columns are
dropped by ``contaminated`` and kept by ``without_passages``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.neardup import numbered, row_name
from tidemill.llm.registry import query, table
from tidemill.llm.staging import staged
from tidemill.llm.textbytes import mix, repeat_index, text_slices, window_hashes, words

LEAST, COVER = 5, 0.5
#: Benchmark words up to this number are sent to every task (16 bytes each).
BROADCAST_WORDS = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Marked words become numbers from here on, each used once; they equal no word's hash but by chance of 2**-64.
_MARKS = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


class Rolling:
    """Karp-Rabin hashes of all windows of one length."""

    def __init__(self, tokens: np.ndarray):
        self.inverse = _powers(_INVERSE, len(tokens))
        self.sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(tokens * _powers(_BASE, len(tokens))[:-1], out=self.sums[1:])

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.inverse[:n] if n > 0 else np.empty(0, np.uint64)


def tiles(text: np.ndarray, item: np.ndarray, least: int) -> tuple[int, int]:
    """Words of ``item`` that greedy tiling covers from ``text``, and the longest tile; tokens are 64-bit numbers."""
    text, item = mix(text), mix(item)
    free, marks, covered, longest, top = np.ones(len(item), bool), 0, 0, 0, len(item)
    while True:
        rolling = Rolling(text), Rolling(item)
        shared = lambda size: bool(np.isin(rolling[1].windows(size), rolling[0].windows(size)).any())
        low, high = least - 1, min(top, len(text))
        while low < high:  # the longest common run of unmarked words
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        if low < least:
            return covered, longest
        there = rolling[0].windows(low)
        order = np.argsort(there, kind="stable")
        there = there[order]
        own = rolling[1].windows(low)
        starts, ends = np.searchsorted(there, own), np.searchsorted(there, own, "right")
        used, progress = np.zeros(len(text), bool), False
        for j in np.flatnonzero(ends > starts):
            if not free[j : j + low].all():
                continue
            for i in order[starts[j] : ends[j]]:
                if not used[i : i + low].any() and (text[i : i + low] == item[j : j + low]).all():
                    used[i : i + low], free[j : j + low] = True, False
                    marks += 2 * low
                    text[i : i + low] = mix(np.arange(marks, marks + low, dtype=np.uint64) + _MARKS)
                    item[j : j + low] = mix(np.arange(marks + low, marks + 2 * low, dtype=np.uint64) + _MARKS)
                    covered, longest, progress = covered + low, max(longest, low), True
                    break
        top = low if progress else low - 1


def _segments(tokens: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Only the words that lie in a shared run, with a word that occurs nowhere else between separate stretches."""
    mask = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(mask, starts, 1)
    np.add.at(mask, np.minimum(starts + width, len(tokens)), -1)
    at = np.flatnonzero(np.cumsum(mask)[:-1] > 0)
    gaps = np.flatnonzero(np.diff(at) > 1) + 1
    return np.insert(tokens[at], gaps, mix(at[gaps].astype(np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5)))


class Benchmark:
    """Words and seeds of all items; its size is that of the benchmark."""

    def __init__(self, ids: list, texts: list[str | None]):
        array = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        self.ids, self.tokens = [], []
        at = 0
        for own, data, offsets in text_slices(array):
            _, _, hashes, firsts = words(data, offsets)
            for k in range(own.num_rows):
                self.ids.append(ids[at + k])
                self.tokens.append(hashes[firsts[k] : firsts[k + 1]].copy())
            at += own.num_rows
        self.widths = {}
        for width in range(1, LEAST + 1):
            items = [k for k, t in enumerate(self.tokens) if (len(t) == width if width < LEAST else len(t) >= width)]
            seeds = [window_hashes(self.tokens[k], width) for k in items]
            if seeds:
                flat, of = np.concatenate(seeds), np.repeat(items, [len(s) for s in seeds])
                order = np.argsort(flat, kind="stable")
                self.widths[width] = (flat[order], of[order])

    def matches(self, data: np.ndarray, offsets: np.ndarray, cover: float):
        """(text number, item number, covered words, longest tile) of all contaminated texts of a slice."""
        _, _, hashes, firsts = words(data, offsets)
        of = repeat_index(firsts)
        for width, (seeds, items) in self.widths.items():
            own = window_hashes(hashes, width)
            if not len(own):
                continue
            place = np.minimum(np.searchsorted(seeds, own), len(seeds) - 1)
            at = np.flatnonzero((seeds[place] == own) & (of[: len(own)] == of[width - 1 :]))
            for d in np.unique(of[at]):
                hits = at[of[at] == d]
                low, high = np.searchsorted(seeds, own[hits]), np.searchsorted(seeds, own[hits], "right")
                wanted = np.unique(np.concatenate([items[a:b] for a, b in zip(low, high)]))
                tokens = hashes[firsts[d] : firsts[d + 1]]
                for k in wanted:
                    mine = np.isin(own[hits], window_hashes(self.tokens[k], width))
                    if int(mine.sum()) and _could(own[hits][mine], self.tokens[k], width, cover):
                        covered, longest = tiles(_segments(tokens, hits[mine] - firsts[d], width), self.tokens[k], width)
                        if covered >= cover * len(self.tokens[k]):
                            yield int(d), int(k), covered, longest


def _could(shared: np.ndarray, item: np.ndarray, width: int, cover: float) -> bool:
    """Whether the item's words that lie in any shared run are enough; tiles cover no others."""
    starts = np.flatnonzero(np.isin(window_hashes(item, width), shared))
    mask = np.zeros(len(item), bool)
    for k in range(width):
        mask[starts + k] = True
    return mask.sum() >= cover * len(item)


def _small(items: DataFrame) -> Benchmark | None:
    """The whole benchmark, if the number of its words allows that; bytes bound the words."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > 2 * BROADCAST_WORDS:
        return None
    rows = items.select(F.col("item_id").cast("long"), "text").collect()
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    return Benchmark([r[0] for r in rows], [r[1] for r in rows])


SCHEMA = "row long, doc_id long, item_id long, item_words long, covered_words long, longest_tile long, coverage double"


def contaminated(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """A row for each contaminated document and item: ``row, doc_id, item_id``, words covered and their share.

    ``row`` tells the rows of ``docs`` apart within this result; another read may number them otherwise.
    """
    items = benchmark.select("item_id", "text").where(F.length("text") > 0)  # others match nothing and have no bound in bytes
    own = _small(items)
    if own is None:
        return _joined(numbered(docs.select("doc_id", "text")), items, cover)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")

    def batches(stream):
        for batch in stream:
            for part, data, offsets in text_slices(batch):
                found = list(own.matches(data, offsets, cover))
                if found:
                    d, k, covered, longest = map(np.array, zip(*found))
                    sizes = np.array([len(own.tokens[x]) for x in k])
                    ids = pa.array([own.ids[x] for x in k], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("row").take(pa.array(d)), part.column("doc_id").take(pa.array(d)), ids, pa.array(sizes), pa.array(covered), pa.array(longest), pa.array(covered / sizes)],
                        ["row", "doc_id", "item_id", "item_words", "covered_words", "longest_tile", "coverage"],
                    )

    return rows.mapInArrow(batches, SCHEMA)


def _seed_rows(frame: DataFrame, key: str) -> DataFrame:
    """``key, seed, width``: the distinct seeds of each text; a text gives seeds of every width up to LEAST."""

    def batches(stream):
        for batch in stream:
            for own, data, offsets in text_slices(batch):
                _, _, hashes, firsts = words(data, offsets)
                of = repeat_index(firsts)
                for width in range(1, LEAST + 1):
                    wide = window_hashes(hashes, width)
                    good = of[: len(wide)] == of[width - 1 :] if len(wide) else np.empty(0, bool)
                    d, h = of[: len(wide)][good], wide[good]
                    if key == "item":
                        size = np.diff(firsts)[d]
                        good = (size == width) if width < LEAST else (size >= width)
                        d, h = d[good], h[good]
                    yield pa.RecordBatch.from_arrays([own.column(key).take(pa.array(d)), pa.array(h.view(np.int64)), pa.array(np.full(len(d), width))], [key, "seed", "width"])

    return frame.select(key, "text").mapInArrow(batches, f"{key} long, seed long, width long").distinct()


def _joined(docs: DataFrame, items: DataFrame, cover: float) -> DataFrame:
    """The same for numbered documents and a benchmark of any size: seeds are joined, then the texts of candidate pairs meet."""
    rows = docs.select(F.col("__row").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = staged(items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), "text"), "benchmark-items")
    pairs = _seed_rows(rows, "row").join(_seed_rows(items, "item"), ["seed", "width"]).select("row", "item").distinct()
    both = pairs.join(rows, "row").join(items.withColumnRenamed("text", "item_text"), "item").select("row", "doc_id", "item_id", "text", "item_text")

    def batches(stream):
        for batch in stream:
            for row in batch.to_pylist():
                one = Benchmark([row["item_id"]], [row["item_text"]])
                for _, data, offsets in text_slices(pa.RecordBatch.from_arrays([pa.array([row["text"]], pa.string())], ["text"])):
                    for _, _, covered, longest in one.matches(data, offsets, cover):
                        size = len(one.tokens[0])
                        values = [row["row"], row["doc_id"], row["item_id"], size, covered, longest]
                        yield pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in values], pa.array([covered / size])], [x.split()[0] for x in SCHEMA.split(", ")])

    return both.mapInArrow(batches, SCHEMA)


def without_passages(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """The rows of ``docs``, all columns, that no item contaminates."""
    items = benchmark.select("item_id", "text").where(F.length("text") > 0)  # others match nothing and have no bound in bytes
    own = _small(items)
    if own is None:
        row = row_name(docs.columns)
        docs = numbered(docs, row)
        spoiled = _joined(docs.select(F.col(row).alias("__row"), "doc_id", "text"), items, cover).select("row").distinct()
        return docs.join(spoiled.withColumnRenamed("row", row), row, "left_anti").drop(row)

    def batches(stream):
        for batch in stream:
            for part, data, offsets in text_slices(batch):
                keep = np.ones(part.num_rows, bool)
                keep[[d for d, *_ in own.matches(data, offsets, cover)]] = False
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(batches, docs.schema)


@query("op7_decontaminate")
def op7_decontaminate(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")
