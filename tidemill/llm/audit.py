"""Operator 12: how filters act on each other, decided on a sparse document-term matrix.

The distinct words of a slice of documents get local codes, in the order of the bucket that a word's hash names.  Each bucket
of words is numbered once for all slices: together the buckets are one dictionary.  A shard holds the documents of a slice as
compressed sparse rows: where each row begins, its terms and how often each stands there.  The sum of a row's counts is its
number of words, the number of its entries that of its distinct words.  Texts are read once and never shuffled: what moves
is the distinct words of each slice, as one row for each bucket, their numbers, and the matrix.  A word is told once for
each slice, however often it stands there.

Cases: a null text is empty; null and empty texts are equal to each other; a null source is the part with the empty name;
rows of a null doc_id never copy a smaller one; repeated rows count each time; several labels of a document count as one that
is 1 if any of them is; without labels nothing is lost; an empty table gives no rows; extra columns are not read; a very
long text is a slice of its own.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.staging import staged
from tidemill.llm.textbytes import SpanHashes, code_points, repeat_index, runs, text_bytes, text_slices

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 2
SIGNS = "#$%&*|"
SHARD_BYTES = 4 << 20
FULL = 120  # orders

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in SIGNS]] = True
BITS = {name: 1 << k for k, name in enumerate(FILTERS)}

#: A term's number is its bucket's times this, and its place there.
BUCKET_TERMS = 1 << 40
DOCUMENTS = "doc_id array<bigint>, part array<string>, digest array<binary>, signs array<int>"
SHARD = f"{DOCUMENTS}, begins binary, codes binary, counts binary, words array<struct<bucket: int, lengths: binary, spelled: binary>>"
NUMBERED = "bucket int, shard long, first long, places binary, fresh array<binary>"


def _rows_of(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def local_codes(data: np.ndarray, offsets: np.ndarray, buckets: int):
    """The distinct words of a slice by bucket, and its compressed sparse rows (begins, codes, counts).  Arrow compares whole
    words, so no two words share a code."""
    solid = ~_SPACE[data]
    starts, ends = runs(solid, offsets)
    if not len(starts):
        return [], np.zeros(len(offsets), np.int64), np.empty(0, np.uint32), np.empty(0, np.uint32)
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    spelled = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[solid]))])
    coded = spelled.dictionary_encode()
    letters, places = text_bytes(coded.dictionary)
    bucket = (SpanHashes(letters).of(places[:-1], places[1:]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    code = np.empty(len(order), np.int64)
    code[order] = np.arange(len(order))
    cells = repeat_index(np.searchsorted(starts, offsets)) * len(order) + code[coded.indices.to_numpy()]
    del spelled, bounds, starts, ends, solid
    cells, counts = np.unique(cells, return_counts=True)
    begins = np.searchsorted(cells, np.arange(len(offsets)) * len(order))
    letters, places = text_bytes(coded.dictionary.take(pa.array(order)))
    del coded
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
    words = [
        {"bucket": int(bucket[order[low]]), "lengths": np.diff(places[low : high + 1]).astype(np.uint32).tobytes(), "spelled": letters[places[low] : places[high]].tobytes()}
        for low, high in zip(cuts[:-1], cuts[1:], strict=True)
    ]
    return words, begins, (cells % len(order)).astype(np.uint32), counts.astype(np.uint32)


def narrow(numbers: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest needs, this width in front."""
    width = next(w for w in (1, 2, 4) if not len(numbers) or numbers.max() < 1 << (8 * w))
    return bytes((width,)) + numbers.astype(f"<u{width}").tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def _gathered(batches):
    """Arrow batches put together to about the bytes of a shard."""
    held, size = [], 0
    for batch in batches:
        own = int(text_bytes(batch.column("text"))[1][-1])
        if held and size + own > SHARD_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _slices(buckets: int):
    def batches(stream):
        """One row for each slice: its documents with the flags of single characters, its local matrix and words."""
        kept = (("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()))
        spelled = pa.list_(pa.struct([("bucket", pa.int32()), ("lengths", pa.binary()), ("spelled", pa.binary())]))
        for batch in _gathered(stream):
            for rows, data, offsets in text_slices(batch, "text", SHARD_BYTES):
                words, begins, codes, counts = local_codes(data, offsets, buckets)
                points = code_points(data)
                capitals = 100 * _rows_of(_CAPITAL[data], offsets) > MOST_CAPITALS_PERCENT * (points[offsets[1:]] - points[offsets[:-1]])
                signs = BITS["C"] * capitals + BITS["D"] * (_rows_of(_SIGN[data], offsets) > 0)
                lists = [pa.array([rows.column(k).to_pylist()], pa.list_(kind)) for k, kind in kept]
                lists.append(pa.array([signs.astype(np.int32)], pa.list_(pa.int32())))
                steps = np.diff(codes.astype(np.int64), prepend=0)
                steps[begins[:-1][np.diff(begins) > 0]] = codes[begins[:-1][np.diff(begins) > 0]]  # a row's first code is told whole
                matrix = [pa.array([narrow(x)], pa.binary()) for x in (np.diff(begins), steps, counts)]
                names = ["doc_id", "part", "digest", "signs", "begins", "codes", "counts", "words"]
                yield pa.RecordBatch.from_arrays([*lists, *matrix, pa.array([words], spelled)], names)

    return batches


def local_shards(docs: DataFrame) -> DataFrame:
    """Written slices of documents, each with a number of its own (``shard``)."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), "text")
    return staged(read.mapInArrow(_slices(buckets), SHARD).withColumn("shard", F.monotonically_increasing_id()), "audit-shards")


def _numbered(batches):
    """Places of words in their buckets, in the order in which they come; ``fresh`` are those not seen before."""
    known: dict[int, dict[bytes, int]] = {}
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            own = known.setdefault(row["bucket"], {})
            lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
            ends = np.cumsum(lengths)
            spelled, first = row["spelled"], len(own)
            words = [spelled[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
            places = np.fromiter((own.setdefault(w, len(own)) for w in words), np.uint32, len(words))
            found.append((row["bucket"], row["shard"], first, places.tobytes(), [w for w, p in zip(words, places.tolist(), strict=True) if p >= first]))
        types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(types)], ["bucket", "shard", "first", "places", "fresh"])


def numbered_words(shards: DataFrame) -> DataFrame:
    """The numbers of each shard's words.  A bucket is numbered by one task, and what it wrote holds: a task that runs again
    may number in another order, but all shards read the same."""
    words = shards.select("shard", F.explode("words").alias("w")).select("w.bucket", "shard", "w.lengths", "w.spelled")
    buckets = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(words.repartition(buckets, "bucket").mapInArrow(_numbered, NUMBERED), "audit-numbers")


def dictionary(numbers: DataFrame) -> DataFrame:
    """``word, term``: every distinct word with its number."""
    told = numbers.select("bucket", "first", F.posexplode("fresh").alias("at", "word"))
    return told.select("word", (F.col("bucket") * F.lit(BUCKET_TERMS) + F.col("first") + F.col("at")).alias("term"))


def _encoded(batches):
    for batch in batches:
        begins, terms, counts = [], [], []
        for row in range(batch.num_rows):
            code = [batch.column(k)[row] for k in ("begins", "codes", "counts", "parts")]
            own = np.concatenate([p["bucket"] * BUCKET_TERMS + np.frombuffer(p["places"], np.uint32).astype(np.int64) for p in code[3].as_py() or ()] or [np.empty(0, np.int64)])
            sizes = widened(code[0].as_py()).astype(np.int64)
            starts = np.zeros(len(sizes) + 1, np.int64)
            np.cumsum(sizes, out=starts[1:])
            steps = widened(code[1].as_py()).astype(np.int64)
            sums = np.cumsum(steps)
            firsts = starts[:-1]
            before = np.where(firsts > 0, sums[np.maximum(firsts, 1) - 1], 0) if len(sums) else np.zeros(len(sizes), np.int64)
            begins.append(starts.tobytes())
            terms.append(own[sums - np.repeat(before, sizes)].tobytes())
            counts.append(widened(code[2].as_py()).astype(np.uint32).tobytes())
        kept = ["doc_id", "part", "digest", "signs"]
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in kept] + [pa.array(x, pa.binary()) for x in (begins, terms, counts)], [*kept, "begins", "terms", "counts"])


def term_matrix(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """The shards as compressed sparse rows over the numbers of the dictionary (``begins``, ``terms``, ``counts``)."""
    parts = numbers.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("bucket", "places"))).alias("parts"))
    joined = shards.drop("words").join(parts, "shard", "left")
    return joined.drop("shard").mapInArrow(_encoded, f"{DOCUMENTS}, begins binary, terms binary, counts binary")


def _decided(batches):
    """Filters A and B from row sums and numbers of entries, beside the other flags of a document."""
    for batch in batches:
        found = []
        for k in range(batch.num_rows):
            begins = np.frombuffer(batch.column("begins")[k].as_py(), np.int64)
            counts = np.frombuffer(batch.column("counts")[k].as_py(), np.uint32)
            sums = np.zeros(len(counts) + 1, np.int64)
            np.cumsum(counts, out=sums[1:])
            words, distinct = sums[begins[1:]] - sums[begins[:-1]], np.diff(begins)
            found.append(BITS["A"] * (words < LEAST_WORDS) + BITS["B"] * (100 * distinct < LEAST_DISTINCT_PERCENT * words))
        flat = [batch.column(k).flatten() for k in ("doc_id", "part", "digest", "signs")]
        mask = np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int32) | flat[3].to_numpy()
        yield pa.RecordBatch.from_arrays([*flat[:3], pa.array(mask, pa.int32())], ["doc_id", "part", "digest", "mask"])


def flagged(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask``: which filters each document fails, a bit for each."""
    shards = local_shards(docs)
    matrix = term_matrix(shards, numbered_words(shards))
    rows = staged(matrix.mapInArrow(_decided, "doc_id long, part string, digest binary, mask int"), "audit-rows")
    # written, so that both sides of the join are plain shuffles and a text with very many copies can be split
    copies = staged(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"), "audit-copies")
    copied = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return rows.join(copies, "digest", "left").select("doc_id", "part", F.col("mask").bitwiseOR(F.when(copied, BITS["E"]).otherwise(0)).alias("mask"))


def _steps():
    """(order, step, bit of its filter, bits of the filters before it) for all orders."""
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            yield "".join(order), step, BITS[name], before
            before |= BITS[name]


def interactions(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of each part, order and step, from (doc_id, part, mask)."""
    one = lambda name: F.max(F.coalesce((F.col(name) == 1).cast("int"), F.lit(0))).alias(name)
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic"))
    total = lambda name: F.sum(F.coalesce(name, F.lit(0))).alias(name)
    kinds = flags.join(known, "doc_id", "left").groupBy("part", "mask").agg(F.count("*").alias("n"), total("quality"), total("toxic"))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(e).alias("before")) for o, s, b, e in _steps()])
    each = kinds.select("*", F.explode(steps).alias("s")).select("*", "s.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) > 0
    gone = F.col("mask").bitwiseAND(F.col("before")) > 0
    count = lambda when, what="n": F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")
    return each.withColumn("share", F.col("n") * F.when(F.col("mask") > 0, F.lit(FULL) / F.bit_count("mask")).otherwise(0).cast("long")).groupBy("part", "filter_order", "step").agg(
        count(F.col("mask").bitwiseAND(F.col("before").bitwiseOR(F.col("bit"))) == 0).alias("kept"),
        count(fails & ~gone).alias("removed"),
        count(fails & gone).alias("redundant"),
        count(F.col("mask") == F.col("bit")).alias("unique_fails"),
        count(fails & ~gone, "quality").alias("good_lost"),
        count(fails & ~gone, "toxic").alias("toxic_lost"),
        count(fails, "share").alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(flagged(docs), labels)


def _sql() -> str:
    steps = ", ".join(f"('{o}', {s}, {b}, {e})" for o, s, b, e in _steps())
    return f"""
    WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+') AS words FROM documents),
    least AS (SELECT text, min(doc_id) AS least FROM w GROUP BY 1),
    known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
    flags AS (SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < {LEAST_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < {LEAST_DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > {MOST_CAPITALS_PERCENT} * length(w.text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(w.text, '[{SIGNS}]') THEN 8 ELSE 0 END + CASE WHEN w.doc_id > least THEN 16 ELSE 0 END AS mask
        FROM w JOIN least USING (text) LEFT JOIN known ON known.doc_id = w.doc_id),
    kinds AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY 1, 2),
    steps(filter_order, step, bit, earlier) AS (VALUES {steps}),
    acts AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & earlier > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
        FROM kinds, steps GROUP BY 1, 2, 3, 4)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
        (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM acts"""


@query("op12_audit", _sql())
def op12_audit(spark, sf_dir):
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
