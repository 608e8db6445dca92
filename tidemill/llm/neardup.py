"""Operator 5: near-duplicate documents by BagMinHash signatures, bands and multiset overlap.

A text is the multiset of its runs of five words (lower-cased ASCII; a shorter text is one run).  BagMinHash with integer
weights: the weight axis of a shingle is cut into the blocks [0,1), [1,2), [2,4), [4,8), ...; each block is a Poisson
process whose points have a time, a register and a level inside the block, all drawn from the shingle's hash; points
below the shingle's count are kept.  A register keeps its earliest point, so two signatures agree in a register with the
weighted Jaccard similarity as probability.  Equal bands of four registers make candidates, which the exact multiset
overlap confirms at 0.8 or more.

No pairs of a whole bucket are made.  Every member of a bucket is compared with the bucket's first member (in one of four
orders, by band), and links join components.  In a bucket that still holds several components, members outside the
largest one are compared with one member of that, which differs from band to band.  What is open then is finished
exactly by the prefix filter of similarity joins: the units of a bag are ordered from the rarest on, and two bags that
overlap enough share a unit among the first ones of both, at places that leave room for the overlap.  Members of
different components that share such a unit, and whose sizes and sketches allow it, are met in blocks of bounded size; first each takes its best partner only,
then its best one in each other component, and what is still open meets all that the filter leaves.  Equal texts are one
node, so copies cost one row each.

Cases: equal texts are always of one class, empty ones too; a null text is a class of its own for each row; texts without
a word are compared for equality only; the class id is the smallest doc_id of the class (null if all are null); repeated rows are copies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.components import components
from tidemill.llm.registry import query, table
from tidemill.llm.staging import staged
from tidemill.llm.textbytes import mix, repeat_index, text_slices, window_hashes, words

REGISTERS, ROWS = 80, 4
BANDS = REGISTERS // ROWS
WIDTH, SIMILAR = 5, 0.8
#: Pairs whose signatures agree in fewer registers are not looked at: 4.5 standard deviations below 0.8.
LEAST_EQUAL = 48
ORDERS = (0, 0x5A3C96E7, 0x2B51_0000_3C0F, 0x7D00_1F35_0000)
#: Rows of the two sides of a block, and pairs that are held at a time.
BLOCK, CHUNK, PAIRS = 1024, 4096, 1 << 18
#: Counts of units decide their order.  Units share this many counts, which bounds the table; any order gives right results.
COUNTS = 1 << 18
#: Bags of about one size are met together: sizes of a cell differ by this factor at most.
CELL = 1.1
#: Bits of a bag's sketch, in words of 64: each unit flips one of them, so that two bags differ in as many units at least as their sketches in bits.
SKETCH = 8
#: Tasks over which the rows of one key are spread in a join.
SALTS = 16
#: Ids of a size up to this are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of all runs of ``width`` words, in order; a text of fewer words is one run."""
    _, _, hashes, firsts = words(data, offsets)
    of = repeat_index(firsts)
    n = len(firsts) - 1
    counts = np.diff(firsts)
    if len(hashes) >= width:
        wide = window_hashes(hashes, width)
        inside = of[: len(wide)] == of[width - 1 :]
        texts, found = of[: len(wide)][inside], wide[inside]
    else:
        texts, found = np.empty(0, np.int64), np.empty(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        total = counts[short].astype(np.uint64)
        for k in range(width - 1):
            has = counts[short] > k
            own = np.where(has, hashes[np.minimum(firsts[short] + k, len(hashes) - 1)], np.uint64(0))
            total = mix(total * _STEP + own)
        texts, found = np.concatenate([texts, short]), np.concatenate([found, total])
        order = np.argsort(texts, kind="stable")
        texts, found = texts[order], found[order]
    return texts, found


def counted(texts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct shingles with their counts."""
    order = np.lexsort((hashes, texts))
    a, b = texts[order], hashes[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    return a[at], b[at], np.diff(np.concatenate([at, [len(a)]]))


def signatures(texts: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash signatures (n x registers, int32) from distinct shingles and their counts; texts without any get zeros."""
    height = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64)  # blocks beside the first
    of = np.repeat(np.arange(len(texts)), height + 1)
    block = np.arange(len(of)) - np.repeat(np.cumsum(height + 1) - height - 1, height + 1)
    low = np.where(block > 0, 1 << np.maximum(block - 1, 0), 0)
    size = np.where(block > 0, low, 1)
    seed = mix(hashes[of] + block.astype(np.uint64) * _STEP)
    text, count = texts[of], counts[of]
    time = np.zeros(len(of))
    best = np.full((n, registers), np.inf)
    flat = best.reshape(-1)
    while len(seed):
        seed = seed + _STEP
        one = mix(seed)
        two = mix(one ^ _STEP)
        time = time - np.log(((one >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / size
        level = low + ((two & np.uint64(0xFFFFFFFF)).astype(np.int64) * size >> 32)
        register = ((two >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        kept = level < count
        np.minimum.at(flat, text[kept] * registers + register[kept], time[kept])
        going = time < best.max(axis=1)[text]
        seed, text, count, time, low, size = seed[going], text[going], count[going], time[going], low[going], size[going]
    best[~np.isfinite(best)] = 0
    return (mix(best.view(np.uint64)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """n x BANDS 64-bit hashes."""
    rows = signature.view(np.uint32).astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]) * _STEP
    for k in range(ROWS):
        total = mix(total * _STEP + rows[:, :, k])
    return total.view(np.int64)


def units(texts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The multisets as sets: each occurrence of a shingle is a unit of its own, hashed to 32 bits."""
    a, b, counts = counted(texts, hashes)
    occurrence = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(a, counts), (mix(np.repeat(b, counts) + occurrence.astype(np.uint64) * _STEP) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _lists(owners: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    places = np.searchsorted(owners, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(values))


def row_name(names: list[str]) -> str:
    """A name for a row number that no column has."""
    name = "__row"
    while name in {n.lower() for n in names}:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str = "__row") -> DataFrame:
    """``docs`` written with a row number.

    A row number depends on the file splits, and these on the cores at the time of a read; so it is drawn once, and all
    reads that are joined by it take it from what was written.
    """
    return staged(docs.withColumn(name, F.monotonically_increasing_id()), "numbered-rows")


def signed_rows(docs: DataFrame) -> DataFrame:
    """``row, doc_id, key, n, sig`` of every row of numbered documents: the text's digest, its number of shingles, its signature (null without a word)."""

    def batches(stream):
        for batch in stream:
            for own, data, offsets in text_slices(batch):
                n = own.num_rows
                texts, hashes = shingles(data, offsets)
                found = signatures(*counted(texts, hashes), n)
                size = np.bincount(texts, minlength=n)
                places = pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, REGISTERS, 0))]).astype(np.int32))
                sig = pa.ListArray.from_arrays(places, pa.array(found[size > 0].ravel()))
                yield pa.RecordBatch.from_arrays([own.column("row"), own.column("doc_id"), own.column("key"), pa.array(size), sig], ["row", "doc_id", "key", "n", "sig"])

    rows = docs.select(F.col("__row").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("key"), "text")
    return rows.mapInArrow(batches, "row long, doc_id long, key string, n long, sig array<int>")


def _bands(nodes: DataFrame) -> DataFrame:
    """``node, slot, band`` of every node with a signature."""

    def batches(stream):
        for batch in stream:
            if batch.num_rows:
                found = band_hashes(np.asarray(batch.column("sig").flatten()).reshape(-1, REGISTERS))
                node = np.repeat(np.asarray(batch.column("node")), BANDS)
                slot = np.tile(np.arange(BANDS, dtype=np.int64), batch.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(slot), pa.array(found.ravel())], ["node", "slot", "band"])

    return nodes.where("n > 0").select("node", "sig").mapInArrow(batches, "node long, slot long, band long")


def _equal_registers(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).sum(axis=-1)


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose sizes and signatures allow the wanted similarity."""

    def batches(stream):
        for batch in stream:
            if batch.num_rows:
                x, y = (np.asarray(batch.column(c).flatten()).reshape(-1, REGISTERS) for c in ("sa", "sb"))
                good = np.flatnonzero(_equal_registers(x, y) >= LEAST_EQUAL)
                yield batch.select(["a", "b"]).take(pa.array(good))

    left = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa"), F.col("n").alias("na"))
    right = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb"), F.col("n").alias("nb"))
    near = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") >= SIMILAR * F.greatest("na", "nb"))
    return near.select("a", "b", "sa", "sb").mapInArrow(batches, "a long, b long")


def _bags(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, units`` of the wanted nodes (``node, row``), from their whole texts in numbered documents."""
    few = wanted.count() * 16 <= BROADCAST_BYTES
    rows = docs.select(F.col("__row").alias("row"), "text")

    def listed(stream):
        for batch in stream:
            for own, data, offsets in text_slices(batch):
                of, found = units(*shingles(data, offsets))
                order = np.lexsort((found, of))
                yield pa.RecordBatch.from_arrays([own.column("node"), _lists(of, found[order], own.num_rows)], ["node", "units"])

    return rows.join(F.broadcast(wanted) if few else wanted, "row").select("node", "text").mapInArrow(listed, "node long, units array<int>")


def _overlap(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted bags overlap enough: the sum of minima over the sum of maxima, counted in units."""
    both = np.concatenate([x, y])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return same >= SIMILAR * (len(x) + len(y) - same)


def _confirmed(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """Pairs whose multisets of shingles overlap by SIMILAR or more."""

    def overlap(stream):
        for batch in stream:
            sides = [(np.asarray(c.flatten()), np.concatenate([[0], np.cumsum(np.asarray(c.value_lengths()))])) for c in (batch.column("ua"), batch.column("ub"))]
            (x, at), (y, bt) = sides
            good = [k for k in range(batch.num_rows) if _overlap(x[at[k] : at[k + 1]], y[bt[k] : bt[k + 1]])]
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    left, right = bags.select(F.col("node").alias("a"), F.col("units").alias("ua")), bags.select(F.col("node").alias("b"), F.col("units").alias("ub"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ua", "ub").mapInArrow(overlap, "a long, b long")


def _met(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """``rows`` (with a ``node``) joined to ``groups`` on a key that most rows may hold: its rows lie in SALTS tasks by their node."""
    copies = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(copies, [key, "salt"]).drop("salt")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open(members: DataFrame, key: str) -> DataFrame:
    """The keys whose members are of several components: the largest of these, members, strays outside it, and how many are ``small``."""
    parts = members.groupBy(key, "root").agg(F.count("*").alias("size"), F.sum("small").alias("small"))
    first = lambda c: F.max_by(c, F.struct("size", "root"))
    total = parts.groupBy(key).agg(first("root").alias("large"), first("small").alias("inner"), F.sum("small").alias("small"), F.sum("size").alias("members"), F.max("size").alias("most"), F.count("*").alias("roots"))
    return total.where("roots > 1").select(key, "large", "members", (F.col("members") - F.col("most")).alias("strays"), "inner", (F.col("small") - F.col("inner")).alias("outer"))


def _unfinished(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Members ``band, node, root, large`` of the buckets with several components."""
    members = _rooted(shared.select("band", "node"), roots)
    return _met(members, _open(members.withColumn("small", F.lit(0)), "band").select("band", "large"), "band")


def _second_stars(members: DataFrame) -> DataFrame:
    """Each stray with one member of the largest component of its bucket; every bucket takes another order of the nodes."""
    order = F.col("band").bitwiseAND(F.lit((1 << 62) - 1))
    heads = members.where("root = large").groupBy("band").agg(F.min(F.col("node").bitwiseXOR(order)).alias("head"))
    pairs = _met(members.where("root != large"), heads, "band").withColumn("head", F.col("head").bitwiseXOR(order))
    return pairs.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def _place(found: np.ndarray) -> np.ndarray:
    return (mix(found.view(np.uint32).astype(np.uint64)) >> np.uint64(32)).astype(np.int64) % COUNTS


def _unit_counts(bags: DataFrame) -> np.ndarray:
    """How often units occur in the bags, units with the same place together: COUNTS numbers."""

    def batches(stream):
        counts = np.zeros(COUNTS, np.int64)
        for batch in stream:
            counts += np.bincount(_place(np.asarray(batch.column("units").flatten())), minlength=COUNTS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["place", "n"])

    rows = bags.select("units").mapInArrow(batches, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # 4 MB; as Row objects 100 MB
    out = np.zeros(COUNTS, np.int64)
    out[rows["place"].to_numpy()] = rows["n"].to_numpy()
    return out


def least_shared(size: np.ndarray) -> np.ndarray:
    """Units that two bags of ``size`` units in all share at least, if they overlap enough."""
    return np.ceil(SIMILAR / (1 + SIMILAR) * size - 1e-9).astype(np.int64)


def sketches(owners: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    """n x SKETCH words: for each bit, whether an odd number of the bag's units falls on it."""
    at = (mix(found.view(np.uint32).astype(np.uint64) + _STEP) >> np.uint64(32)).astype(np.int64) % (SKETCH * 64)
    places, counts = np.unique(owners * (SKETCH * 64) + at, return_counts=True)
    bits = np.zeros(n * SKETCH * 64, np.uint8)
    bits[places[counts % 2 == 1]] = 1
    return np.packbits(bits).view(np.int64).reshape(n, SKETCH)


def differing_bits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=1).astype(np.int64)


@dataclass
class Prefixes:
    """Rarest units of bags, one entry each: owner, unit, place, the largest size a partner may have, and cell of sizes.

    A bag needs its first ``n - ceil(0.8 n) + 1`` units to meet smaller bags, and fewer of them (``small``) to meet larger ones.
    It is ``small`` in the cell of its own size, and stands in each cell of sizes that it may meet as the larger one.
    """

    owner: np.ndarray
    unit: np.ndarray
    at: np.ndarray
    limit: np.ndarray
    cell: np.ndarray
    small: np.ndarray


def prefixes(owners: np.ndarray, found: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> Prefixes:
    order = np.lexsort((found, counts[_place(found)], owners))
    owners, found = owners[order], found[order]
    n = sizes[owners]
    at = np.arange(len(owners)) - (np.cumsum(sizes) - sizes)[owners]
    kept = at <= n - np.ceil(SIMILAR * n - 1e-9)
    owners, found, at, n = owners[kept], found[kept], at[kept], n[kept]
    # room for the overlap: n - at >= SIMILAR / (1 + SIMILAR) * (n + size of the partner)
    limit = np.floor((1 + SIMILAR) / SIMILAR * (n - at) + 1e-9).astype(np.int64) - n
    cell = lambda size: np.floor(np.log(np.maximum(size, 1)) / np.log(CELL)).astype(np.int64)
    low, high = cell(np.ceil(SIMILAR * n - 1e-9)), cell(np.minimum(n, limit))
    width = np.maximum(high - low + 1, 0)
    of = np.repeat(np.arange(len(owners)), width)
    cells = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + low[of]
    return Prefixes(owners[of], found[of], at[of], limit[of], cells, (limit >= n)[of] & (cells == cell(n)[of]))


def _prefix_rows(bags: DataFrame) -> DataFrame:
    """``meet, node, n, at, small, sketch`` of every bag and each of its prefix units and cells (``meet``), where a partner may be."""
    counts = bags.sparkSession.sparkContext.broadcast(_unit_counts(bags))

    def batches(stream):
        for batch in stream:
            sizes = np.asarray(batch.column("units").value_lengths()).astype(np.int64)
            owners = np.repeat(np.arange(batch.num_rows), sizes)
            p = prefixes(owners, np.asarray(batch.column("units").flatten()), sizes, counts.value)
            columns = [p.unit.astype(np.int64) * 1024 + p.cell, np.asarray(batch.column("node"))[p.owner], sizes[p.owner], p.at, p.limit, p.small.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["meet", "node", "n", "at", "limit", "small"])

    def sketched(stream):
        for batch in stream:
            owners = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column("units").value_lengths()).astype(np.int64))
            own = sketches(owners, np.asarray(batch.column("units").flatten()), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([x.tobytes() for x in own], pa.binary())], ["node", "sketch"])

    rows = staged(bags.select("node", "units").mapInArrow(batches, "meet long, node long, n long, at long, limit long, small long"), "near-prefixes")
    asking = F.col("small") == 1
    bounds = rows.groupBy("meet").agg(F.min(F.when(asking, F.col("n"))).alias("least"), F.max(F.when(asking, F.col("limit"))).alias("most"), F.count("*").alias("rows")).where("least is not null and rows > 1")
    met = _met(rows, bounds, "meet").where("limit >= least and n <= most").select("meet", "node", "n", "at", "small")
    return met.join(bags.select("node", "units").mapInArrow(sketched, "node long, sketch binary"), "node")


def _partners(frame: pd.DataFrame, once: bool) -> pd.DataFrame:
    """Pairs of asking bags with larger ones of other components, block by block, that the places of their shared unit allow.

    ``room`` is what the shared units may exceed the needed ones by; what the sketches differ by must leave enough shared ones, too.  ``once`` leaves an asker's best partner of each component.
    """
    frame = frame.sort_values(["meet", "part", "block", "chunk", "asks"])
    key = frame[["meet", "part", "block", "chunk"]].to_numpy()
    cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(frame)]])
    asking, node, root, n, at = (frame[c].to_numpy() for c in ("asks", "node", "root", "n", "at"))
    of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    members = np.bincount(of[~asking], minlength=len(cuts) - 1)
    asks = np.flatnonzero(asking)
    width, low = members[of[asks]], cuts[of[asks]]
    sketch = np.frombuffer(b"".join(frame["sketch"]), np.int64).reshape(-1, SKETCH)
    ends, found, begin = np.cumsum(width), [], 0
    while begin < len(asks):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        w = width[begin:end]
        x = np.repeat(asks[begin:end], w)
        y = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(low[begin:end], w)
        room = np.minimum(n[x] - at[x], n[y] - at[y]) - least_shared(n[x] + n[y])
        good = (root[x] != root[y]) & (n[x] <= n[y]) & (room >= 0) & (n[x] >= SIMILAR * n[y] - 1e-9)
        x, y, room = x[good], y[good], room[good]
        good = differing_bits(sketch[x], sketch[y]) <= n[x] + n[y] - 2 * least_shared(n[x] + n[y])
        found.append(pd.DataFrame({"node": node[x[good]], "other": node[y[good]], "root": root[y[good]], "room": room[good]}))
        begin = end
    pairs = pd.concat(found) if found else pd.DataFrame({c: np.empty(0, np.int64) for c in ("node", "other", "root", "room")})
    if once:
        pairs = pairs.sort_values(["node", "root", "room", "other"], ascending=[True, True, False, True]).drop_duplicates(["node", "root"])
    return pairs


def _blocks(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Askers and members in blocks: those outside the largest component of a meeting ask all, those inside ask the others."""
    members = staged(_rooted(rows, roots), "near-rooted")
    met = staged(_met(members, _open(members, "meet"), "meet").withColumn("draw", F.xxhash64("node")), "near-open-meets")
    outside, every = F.col("root") != F.col("large"), lambda count: F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
    own, sides = ["node", "root", "n", "at", "sketch"], []
    for part, (who, asked, number, total) in enumerate([(outside, F.lit(True), "outer", "members"), (~outside, outside, "inner", "strays")]):
        blocks, chunks = F.ceil(F.col(number) / BLOCK), F.ceil(F.col(total) / CHUNK)
        some, which = met.where(F.col(number) > 0), F.lit(part).alias("part")
        sides.append(some.where(who & (F.col("small") == 1)).select("meet", which, F.pmod("draw", blocks).alias("block"), every(chunks).alias("chunk"), *own, F.lit(True).alias("asks")))
        sides.append(some.where(asked).select("meet", which, every(blocks).alias("block"), F.pmod("draw", chunks).alias("chunk"), *own, F.lit(False).alias("asks")))
    return staged(sides[0].union(sides[1]).union(sides[2]).union(sides[3]), "near-blocks")


def _prefix_pairs(rows: DataFrame, roots: DataFrame, per: list[str]) -> DataFrame:
    """Pairs ``a, b`` of different components that share a prefix unit; for each ``per`` only the best one, without it all."""
    blocks = _blocks(rows, roots)
    groups = max(1, -(-blocks.count() // CHUNK))  # many units of few members share a group
    pairs = blocks.withColumn("group", F.pmod(F.xxhash64("meet", "part", "block", "chunk"), F.lit(groups))).groupBy("group").applyInPandas(lambda frame: _partners(frame, bool(per)), "node long, other long, root long, room long")
    if per:
        pairs = pairs.groupBy(*per).agg(F.max_by(F.struct(F.col("node").alias("n"), "other"), F.struct("room", "other")).alias("best")).select(F.col("best.n").alias("node"), "best.other")
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links."""
    links = staged(links, "near-links")
    return components(links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))) if links.limit(1).count() else roots


def _last_links(members: DataFrame, nodes: DataFrame, bags: DataFrame, roots: DataFrame) -> DataFrame:
    """Components once every link between members of open buckets is found."""
    rows = staged(_prefix_rows(staged(members.select("node").distinct().join(bags, "node"), "near-open-bags")), "near-prefix-rows")
    for per in (["node"], ["node", "root"], []):
        pairs = staged(_prefix_pairs(rows, roots, per), "near-pairs")
        if pairs.limit(1).count() == 0:
            break
        roots = _joined(roots, _confirmed(_likely(pairs, nodes), bags))
    return roots


def classes(docs: DataFrame) -> DataFrame:
    """``row, doc_id, class_id, key, label``: one row per row of ``docs``, as ``numbered`` gives them."""
    signed = staged(signed_rows(docs), "near-signed")
    keyed = signed.where("key is not null")
    firsts = keyed.groupBy("key").agg(F.min("row").alias("row"), F.min("doc_id").alias("least"))
    nodes = staged(firsts.join(signed.select("row", "n", "sig"), "row").select("key", F.col("row").alias("node"), "row", "least", "n", "sig"), "near-nodes")
    bands = staged(_bands(nodes), "near-bands")
    order = F.element_at(F.array(*[F.lit(o).cast("long") for o in ORDERS]), (F.col("slot") % len(ORDERS) + 1).cast("int"))
    buckets = bands.groupBy("band", "slot").agg(F.min(F.col("node").bitwiseXOR(order)).alias("first"), F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    firsts_of = buckets.select("band", F.col("first").bitwiseXOR(order).alias("first"))
    shared = staged(_met(bands, firsts_of, "band").select("band", "node", "first"), "near-shared")
    bags = staged(_bags(staged(shared.select("node").distinct().select("node", F.col("node").alias("row")), "near-wanted"), docs), "near-bags")
    stars = shared.where("node != first").select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()
    roots = components(staged(_confirmed(_likely(stars, nodes), bags), "near-links"))  # a round reads its links a dozen times
    for finish in (False, True):
        members = staged(_unfinished(shared, roots), "near-open")
        if members.limit(1).count() == 0:
            break
        roots = _last_links(members, nodes, bags, roots) if finish else _joined(roots, _confirmed(_likely(_second_stars(members), nodes), bags))
    linked = nodes.select("node", "key", "least").join(roots, "node", "left").select("key", "least", F.coalesce("root", "node").alias("root"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("class_id"))
    found = staged(linked.join(smallest, "root").select("key", "class_id", F.col("root").alias("label")), "near-classes")
    return signed.select("row", "doc_id", "key").join(found, "key", "left").select("row", "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "key", "label")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their class: the smallest doc_id (nulls last), of repeated rows the first.

    Rows with a null text stay, each for itself.
    """
    row = row_name(docs.columns)
    docs = numbered(docs, row)
    found = staged(classes(docs.select(F.col(row).alias("__row"), "doc_id", "text")).where("key is not null"), "near-members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    groups = found.groupBy("label").agg(F.min(order).alias("best"))
    kept = groups.select(F.col("best.row").alias("row"))
    dropped = staged(found.select("row").join(kept, "row", "left_anti").withColumnRenamed("row", row), "near-dropped")
    few = dropped.count() * 16 <= BROADCAST_BYTES
    return docs.join(F.broadcast(dropped) if few else dropped, row, "left_anti").drop(row)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id`` for every row."""
    return classes(numbered(docs.select("doc_id", "text"))).select("doc_id", "class_id")


@query("op5_near_duplicates")
def op5_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
