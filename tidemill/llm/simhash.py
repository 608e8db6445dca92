"""Operator 13: near duplicates by SimHash, fingerprints compared exactly in tiles.

A document's fingerprint has a bit for each bit of a 64-bit hash; it is set if over half of the hashes of the document's
three-word shingles have it set.  Equal fingerprints are one node.  The nodes are laid in tiles by their population counts:
the bits are cut into equal parts and each part's set bits counted.  Fingerprints within the radius have counts that differ
by the radius at most in sum, so only tiles of such counts meet, each pair of them once: the numbers of one tile are
combined with those of the other by exclusive or, and the set bits of the results are counted.  All other pairs of tiles are
skipped.  More nodes get more parts, so that tiles stay narrow; the result does not depend on it.  A pair of tiles tells the
links that hold its groups together and not all of its pairs.

Cases: null and empty texts, and those of blanks alone, have the fingerprint zero and are linked like any other; one or two
words are one shingle; shingles count as often as they stand there; a null doc_id belongs to its component but is never its
name (null if no member has an id); rows of equal doc_id are rows of their own; an empty table gives no rows; extra columns
are not read; a very long text is handled in runs of shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.components import components
from tidemill.llm.registry import query, table
from tidemill.llm.staging import staged
from tidemill.llm.textbytes import LOWER, runs, text_slices

RADIUS = 3
SHINGLE = 3
SEED = 42
TILE = 4096
RUN = 1 << 12
#: Fewer spans of one length than this, or longer ones than that, are hashed one by one.
FEW, LONG = 16, 4096
#: Parts of a fingerprint whose set bits are counted.
PARTS = (1, 2, 4, 8)

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
# the primes of XXH64, fixed values
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


# -- hashes


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(state, lane: np.ndarray) -> np.ndarray:
    return _rotated(state + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of spans of one byte array.  Spans of equal length advance together, eight bytes at a time; few or very long ones
    are hashed one by one."""
    found = np.empty(len(starts), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    lengths = ends - starts
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        length = int(lengths[order[low]])
        if high - low < FEW or length > LONG:
            for k in order[low:high]:
                found[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]], seed)
            continue
        for first in range(low, high, RUN):
            own = order[first : min(first + RUN, high)]
            found[own] = _equal_spans(padded, eight, starts[own], length, seed)
    return found


def _equal_spans(padded, eight, at, length: int, seed: int) -> np.ndarray:
    step, end = 0, length
    if length >= 32:
        lanes = [np.full(len(at), x % (1 << 64), np.uint64) for x in (seed + int(_P1) + int(_P2), seed + int(_P2), seed, seed - int(_P1))]
        while step + 32 <= end:
            lanes = [_round(lane, eight[at + (step + 8 * k)]) for k, lane in enumerate(lanes)]
            step += 32
        hashes = _rotated(lanes[0], 1) + _rotated(lanes[1], 7) + _rotated(lanes[2], 12) + _rotated(lanes[3], 18)
        for lane in lanes:
            hashes = (hashes ^ _round(np.uint64(0), lane)) * _P1 + _P4
        hashes += np.uint64(length)
    else:
        hashes = np.full(len(at), (seed + int(_P5) + length) % (1 << 64), np.uint64)
    while step + 8 <= end:
        hashes = _rotated(hashes ^ _round(np.uint64(0), eight[at + step]), 27) * _P1 + _P4
        step += 8
    if step + 4 <= end:
        hashes = _rotated(hashes ^ ((eight[at + step] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        step += 4
    while step < end:
        hashes = _rotated(hashes ^ (padded[at + step].astype(np.uint64) * _P5), 11) * _P1
        step += 1
    hashes = (hashes ^ (hashes >> np.uint64(33))) * _P2
    hashes = (hashes ^ (hashes >> np.uint64(29))) * _P3
    return hashes ^ (hashes >> np.uint64(32))


def shingle_spans(data: np.ndarray, offsets: np.ndarray):
    """The words of all texts joined by single blanks, and starts, ends and text numbers of their shingles there."""
    solid = ~_SPACE[data]
    starts, ends = runs(solid, offsets)
    lengths = ends - starts
    shift = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=shift[1:])
    joined = np.full(shift[-1], 32, np.uint8)
    places = np.ones(shift[-1], bool)
    places[shift[1:] - 1] = False
    joined[places] = LOWER[data[solid]]
    firsts = np.searchsorted(starts, offsets)
    counts = np.diff(firsts)
    shingles = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), shingles)
    begun = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(shingles, out=begun[1:])
    word = firsts[:-1][text] + np.arange(len(text)) - begun[:-1][text]
    last = word + np.minimum(counts[text], SHINGLE) - 1
    return joined, shift[word], shift[last] + lengths[last], begun


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each text."""
    joined, starts, ends, begun = shingle_spans(data, offsets)
    hashes = xxh64(joined, starts, ends).astype("<u8")
    # up to 255 shingles are summed in bytes, 64 of them in eight numbers; the sums of a text's segments are then added
    size = np.diff(begun)
    segments = -(-size // 255)
    first = np.zeros(len(size) + 1, np.int64)
    np.cumsum(segments, out=first[1:])
    text = np.repeat(np.arange(len(size)), segments)
    cuts = np.append(begun[:-1][text] + 255 * (np.arange(len(text)) - first[:-1][text]), len(hashes))
    sums = np.zeros((len(text), 8), np.uint64)
    for low in range(0, len(text), 64):
        high = min(low + 64, len(text))
        part = hashes[cuts[low] : cuts[high]].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little").view(np.uint64)
        sums[low:high] = np.add.reduceat(bits, cuts[low:high] - cuts[low], axis=0)
    ones = np.zeros((len(size), 64), np.int64)
    full = np.flatnonzero(size)
    if len(full):
        ones[full] = np.add.reduceat(sums.view(np.uint8).astype(np.int64), first[full], axis=0)
    over = 2 * ones > size[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _printed(batches):
    for batch in batches:
        for rows, data, offsets in text_slices(batch):
            marks = fingerprints(data, offsets).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(marks)], ["doc_id", "mark"])


def printed(docs: DataFrame) -> DataFrame:
    """``doc_id, mark``: the fingerprint of each row as a signed number."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_printed, "doc_id long, mark long")


# -- tiles


def parts_for(nodes: int, tile: int = TILE) -> int:
    """Into how many parts to cut: the fewest for which a tile is not much fuller than ``tile``, were bits thrown by chance."""
    cells = {1: 10, 2: 120, 4: 4_000, 8: 1_000_000}
    return next((k for k in PARTS if nodes <= cells[k] * tile), PARTS[-1])


def _counts(parts: int) -> Column:
    """The set bits of each part, a byte for each, as one number."""
    width = 64 // parts
    mask = (1 << width) - 1
    each = [F.bit_count(F.shiftrightunsigned("mark", k * width).bitwiseAND(F.lit(mask if width < 64 else -1))).cast("long") for k in range(parts)]
    total = each[0]
    for k, one in enumerate(each[1:], 1):
        total = total + F.shiftleft(one, 7 * k)
    return total


def near_counts(parts: int, radius: int = RADIUS) -> list[int]:
    """What to add to a tile's counts to get those of all tiles to meet: every step of the radius at most in sum, and of two
    opposite ones only the one that is not negative."""
    steps = {(): 0}
    for _ in range(parts):
        steps = {(*k, d): n + abs(d) for k, n in steps.items() for d in range(-radius, radius + 1) if n + abs(d) <= radius}
    totals = {sum(d << (7 * k) for k, d in enumerate(step)) for step in steps}
    return sorted(x for x in totals if x >= 0)


def tiled(nodes: DataFrame, parts: int, tile: int = TILE) -> DataFrame:
    """``counts, tile, marks``: nodes of equal counts in tiles of about ``tile`` numbers; a count with many nodes has more
    tiles, dealt by a hash, so that no group outgrows a task."""
    counted = nodes.select("mark", _counts(parts).alias("counts"))
    sizes = counted.groupBy("counts").agg(F.ceil(F.count("*") / tile).cast("long").alias("tiles"))
    # 17 ** 4 counts at most for up to four parts, 16 bytes each; with more the join is a shuffle by many counts
    dealt = counted.join(F.broadcast(sizes) if parts <= 4 else sizes, "counts").withColumn("tile", F.pmod(F.xxhash64("mark"), F.col("tiles")))
    return staged(dealt.groupBy("counts", "tile").agg(F.collect_list("mark").alias("marks")), "simhash-tiles")


def _forest(pairs: np.ndarray, names: np.ndarray) -> list[tuple[int, int]]:
    """Of links between numbered groups, those that join two that were apart; ``names`` gives each its group from then on."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    kept = []
    for k, (a, b) in enumerate(pairs.tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(k)
    if parent:
        ids, inverse = np.unique(names, return_inverse=True)
        names[:] = np.array([root(x) for x in ids.tolist()])[inverse]
    return kept


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, radius: int = RADIUS, rows: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links of two tiles that hold together what lies within the radius: fewer than both have numbers."""
    names = np.arange(len(a) + (0 if same else len(b)))
    shift = 0 if same else len(a)
    left, right = [], []
    for low in range(0, len(a), rows):
        near = np.bitwise_count(a[low : low + rows, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        i += low
        groups = np.stack([names[i], names[j + shift]], 1)
        apart = np.flatnonzero(groups[:, 0] != groups[:, 1])
        if not len(apart):
            continue
        groups = groups[apart]
        groups.sort(axis=1)
        groups, first = np.unique(groups, axis=0, return_index=True)
        kept = apart[first[_forest(groups, names)]]
        left.append(a[i[kept]])
        right.append(b[j[kept]])
    nothing = np.empty(0, np.uint64)
    return np.concatenate([*left, nothing]), np.concatenate([*right, nothing])


def _compared(batches):
    for batch in batches:
        same, ones, others = batch.column("same").to_pylist(), batch.column("ones"), batch.column("others")
        for k in range(batch.num_rows):
            a, b = (x[k].values.to_numpy().view(np.uint64) for x in (ones, others))
            left, right = tile_links(a, b, same[k])
            if len(left):
                yield pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])


def node_links(nodes: DataFrame, radius: int = RADIUS, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """``a, b``: links that join all distinct numbers of ``mark`` within the radius to their groups."""
    cut = parts or parts_for(nodes.count(), tile)
    tiles = tiled(nodes, cut, tile)
    # one pair of tiles is one row of two numbers until the tiles' contents meet in the task that compares them
    keys = tiles.select("counts", "tile")
    steps = F.array(*[F.lit(x).cast("long") for x in near_counts(cut, radius)])
    asked = keys.select("counts", "tile", F.explode(steps).alias("step")).withColumn("meet", F.col("counts") + F.col("step"))
    met = asked.join(keys.select(F.col("counts").alias("meet"), F.col("tile").alias("with")), "meet").where("step > 0 OR tile <= with")
    pairs = met.select("counts", "tile", "meet", "with")
    other = tiles.select(F.col("counts").alias("meet"), F.col("tile").alias("with"), F.col("marks").alias("others"))
    both = pairs.join(tiles.withColumnRenamed("marks", "ones"), ["counts", "tile"]).join(other, ["meet", "with"])
    same = (F.col("counts") == F.col("meet")) & (F.col("tile") == F.col("with"))
    return both.select(same.alias("same"), "ones", "others").mapInArrow(_compared, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    rows = staged(printed(docs), "simhash-marks")
    nodes = staged(rows.groupBy("mark").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-nodes")
    roots = components(staged(node_links(nodes.select("mark")), "simhash-links"))  # compared once, read by each branch of a round
    of = nodes.join(roots, nodes["mark"] == roots["node"], "left").select("mark", "least", "n", "root", F.coalesce("root", "mark").alias("name"))
    names = of.groupBy("name").agg(F.min("least").alias("component_id"), F.sum("n").alias("size"))
    # a document alone in its component is its own name and meets nothing
    known = of.join(names.where("size > 1"), "name").select("mark", "component_id")
    found = rows.join(known, "mark", "left")
    return found.select("doc_id", F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))


@query("op13_simhash")
def op13_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
