"""Operator 11: a Merkle manifest of a table, its trees stored in a van Emde Boas layout.

A tree has eight children to a node.  It is cut into aligned subtrees of ``HEIGHT`` levels above their leaves (512 leaves);
each subtree is one row, and the roots of the subtrees are the leaves of the next tier.  Inside a subtree the digests lie in
a van Emde Boas order: the levels are split at half their height, the top half is stored first and each lower half behind it,
each in the same way.  Where a node lies follows from its depth and number alone, so hashing upwards and looking siblings up
use the same arithmetic, whatever a page or a cache line holds.

Each group (``lang``) has a tree; the group roots are the leaves of one more tree, cut and stored in the same way.

Cases: a null column is ``-``; rows of equal doc_id (null first) stand in the order of their leaves; a null doc_id is never
tampered with; a null lang is a group of its own in front of all others; a group of one row is its own root; one group
alone is the root of all; without any sibling the proof is the digest of nothing; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.staging import staged
from tidemill.llm.textbytes import give_back

FAN = 8
HEIGHT = 3
WIDTH = FAN**HEIGHT
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = "key string, block long, n long, size int, nodes binary, digest binary, ids array<bigint>, changed array<binary>"
PATHS = "key string, block long, top boolean, above binary, subroot binary"
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


# -- addresses


@lru_cache(maxsize=None)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """For each depth, where the nodes of that depth lie in a full tree of so many levels."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    above, below = addresses(top), addresses(levels - top)
    room, each = nodes_of(top), nodes_of(levels - top)
    bases = room + each * np.arange(FAN**top)
    return above + tuple((bases[:, None] + rows[None, :]).ravel() for rows in below)


def nodes_of(levels: int) -> int:
    return (FAN**levels - 1) // (FAN - 1)


def levels_of(leaves: int) -> int:
    """Levels of the smallest tree for so many leaves."""
    levels = 1
    while FAN ** (levels - 1) < leaves:
        levels += 1
    return levels


# -- one subtree


def build(leaves: list[bytes], levels: int) -> np.ndarray:
    """The digests of a subtree in their places (places without a node hold zeros); the root lies at place 0."""
    at, nodes = addresses(levels), np.zeros((nodes_of(levels), 32), np.uint8)
    nodes[at[-1][: len(leaves)]] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32)
    n = len(leaves)
    for depth in range(levels - 2, -1, -1):
        below = nodes[at[depth + 1][:n]].tobytes().hex().encode()
        n = -(-n // FAN)
        step = 64 * FAN
        made = b"".join(sha256(below[k * step : (k + 1) * step]).digest() for k in range(n))
        nodes[at[depth][:n]] = np.frombuffer(made, np.uint8).reshape(-1, 32)
    return nodes


def siblings(nodes: np.ndarray, levels: int, n: int, leaf: int) -> list[tuple[bytes, bytes]]:
    """(what stands left, what stands right) of a leaf's ancestors in their runs, as hex text, from the leaf upwards."""
    at, found = addresses(levels), []
    for depth in range(levels - 1, 0, -1):
        first = leaf // FAN * FAN
        run = nodes[at[depth][first : min(first + FAN, n)]].tobytes().hex().encode()
        own = (leaf - first) * 64
        found.append((run[:own], run[own + 64 :]))
        leaf, n = leaf // FAN, -(-n // FAN)
    return found


def packed(path: list[tuple[bytes, bytes]]) -> bytes:
    """A path as bytes: for each level how many digests stand left and right, then these."""
    return b"".join(bytes((len(a) // 64, len(b) // 64)) + bytes.fromhex((a + b).decode()) for a, b in path)


def unpacked(data: bytes) -> list[tuple[bytes, bytes]]:
    path, k = [], 0
    while k < len(data):
        a, b = data[k], data[k + 1]
        run, k = data[k + 2 : k + 2 + 32 * (a + b)].hex().encode(), k + 2 + 32 * (a + b)
        path.append((run[: 64 * a], run[64 * a :]))
    return path


def folded(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        digest = sha256(left + digest.hex().encode() + right).digest()
    return digest


# -- tiers of subtrees


def _block_levels(n: int) -> int:
    """Levels of the subtrees of a tier with n nodes: all are as high as the others, but for a tier of one subtree."""
    return HEIGHT + 1 if n > WIDTH else levels_of(n)


def _built(batches):
    for batch in batches:
        key, block, total, members = (batch.column(k).to_pylist() for k in ("key", "block", "n", "members"))
        rows = []
        for k, b, n, of in zip(key, block, total, members, strict=True):
            nodes = build([m["digest"] for m in of], _block_levels(n))
            rows.append((k, b, n, len(of), nodes.tobytes(), nodes[0].tobytes(), [m["id"] for m in of], [m["changed"] for m in of]))
        names = ("key", "block", "n", "size", "nodes", "digest", "ids", "changed")
        types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], list(names))
    give_back()


def _tier(rows: DataFrame) -> DataFrame:
    """Subtrees over rows (key, place, n, digest, id, changed), one row each."""
    groups = rows.groupBy("key", F.floor(F.col("place") / WIDTH).cast("long").alias("block"), "n")
    members = groups.agg(F.sort_array(F.collect_list(F.struct("place", "digest", "id", "changed"))).alias("members"))
    return staged(members.mapInArrow(_built, BLOCK), "manifest-tier")


def tiers(leaves: DataFrame) -> list[DataFrame]:
    """All tiers over placed leaves, the lowest first.  Each has a 512th of the rows of the one below, so there are four for
    10^10 leaves; the driver sees one number."""
    most = leaves.agg(F.max("n")).first()[0] or 1
    found = [_tier(leaves)]
    while most > WIDTH:
        most = -(-most // WIDTH)
        roots = found[-1].where(F.col("n") > WIDTH).select(
            "key", F.col("block").alias("place"), F.ceil(F.col("n") / WIDTH).cast("long").alias("n"), "digest",
            F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("changed"))
        found.append(_tier(roots))
    return found


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their ``place`` in the order within ``key``, and ``n``, how many the key has.

    The rows are sorted by ranges of (key, order), so a key with most rows is spread over many ranges; only the numbers of
    rows of each key and range are summed up.  What was sorted is written: places do not change if a task runs again.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, "key", *order).sortWithinPartitions("key", *order)
    ranged = staged(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "manifest-order")
    runs = ranged.groupBy("key", "part").agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "key", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("key")).alias("n"))
    return ranged.join(runs, ["key", "part"]).withColumn("place", F.col("row") + F.col("shift")).drop("part", "row", "shift")


# -- the manifest


def encoded(name: str) -> Column:
    text = F.col(name).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column | None = None) -> Column:
    fields = [encoded(name) for name in FIELDS[:-1]] + [encoded("text") if text is None else text]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def tampered(text: str = "text") -> Column:
    """The encoded text with A-Z lower-cased; the length in bytes stays."""
    return F.translate(encoded(text), UPPER, LOWER)


def leaves(docs: DataFrame) -> DataFrame:
    """``key, id, digest, changed``: the leaf of each row, and that of the tampered row where there is one."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("key"),
        F.col("doc_id").cast("long").alias("id"), _leaf().alias("digest"), F.when(hit, _leaf(tampered())).alias("changed"))


@dataclass(frozen=True)
class Manifest:
    """``groups``: the tiers of the groups' trees; ``tops``: those of the tree over the groups; ``names``: which of its leaves
    is which group; ``root``: the digest of all, None for an empty table."""

    groups: list[DataFrame]
    tops: list[DataFrame]
    names: DataFrame
    root: bytes | None


def manifest(docs: DataFrame) -> Manifest:
    groups = tiers(placed(leaves(docs), "id", "digest"))
    roots = [tier.where(F.col("n") <= WIDTH).select("key", "digest") for tier in groups]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.union(more)
    ordered = placed(subroots.select(F.lit("").alias("key"), F.col("key").alias("group"), "digest"), "group")
    names = staged(ordered.withColumnRenamed("digest", "subroot"), "manifest-groups")
    nothing = {"id": F.lit(None).cast("long"), "changed": F.lit(None).cast("binary")}
    tops = tiers(names.select("key", "place", "n", F.col("subroot").alias("digest")).withColumns(nothing))
    top = tops[-1].where(F.col("n") <= WIDTH).select("digest").first()
    return Manifest(groups, tops, names, None if top is None else bytes(top[0]))


def _read(batch, with_leaves: bool):
    for row in batch.to_pylist():
        levels = _block_levels(row["n"])
        nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
        at = addresses(levels)[-1]
        own = ([siblings(nodes, levels, row["size"], k)] for k in range(row["size"])) if with_leaves else ()
        yield row, nodes, at, own


def _downwards(batches):
    """Paths of the subtrees below: those inside this one, then this one's own."""
    for batch in batches:
        found = [(row["key"], row["block"] * WIDTH + k, False, packed(path) + row["above"], row["subroot"]) for row, _, _, own in _read(batch, True) for k, (path,) in enumerate(own)]
        types = (pa.string(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(types)], ["key", "block", "top", "above", "subroot"])


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    top = blocks.withColumn("top", F.col("n") <= WIDTH)
    return top.join(paths, ["key", "block", "top"])


def paths_to(levels: list[DataFrame], seeds: DataFrame) -> DataFrame:
    """The lowest subtrees with the siblings that stand above each (``above``), from the topmost tier downwards.  ``seeds``
    are the paths of the trees' roots."""
    joined = _with_paths(levels[-1], seeds)
    for tier in reversed(levels[:-1]):
        joined = _with_paths(tier, joined.mapInArrow(_downwards, PATHS).union(seeds))
    return joined


def _proved(root: bytes):
    def batches(stream):
        for batch in stream:
            rows = []
            for row, nodes, at, own in _read(batch, True):
                above = unpacked(row["above"])
                rest = b"".join(a + b for a, b in above)
                for k, (path,) in enumerate(own):
                    leaf = nodes[at[k]].tobytes()
                    proof = sha256(b"".join(a + b for a, b in path) + rest)
                    end = folded(row["changed"][k] or leaf, path + above)
                    rows.append((row["ids"][k], leaf.hex(), row["subroot"].hex(), root.hex(), proof.hexdigest(), end.hex(), end == root))
            types = (pa.int64(), *[pa.string()] * 5, pa.bool_())
            names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)
        give_back()

    return batches


def proofs(of: Manifest, spark) -> DataFrame:
    """The digest of each row's siblings, and the root that its leaf, tampered with or not, folds to."""
    if of.root is None:
        return spark.createDataFrame([], RESULT)
    start = of.names.select("key", F.lit(0).cast("long").alias("block"), F.lit(True).alias("top"), F.lit(b"").alias("above"), F.lit(of.root).alias("subroot")).limit(1)
    found = paths_to(of.tops, start).mapInArrow(_downwards, PATHS)
    seeds = of.names.join(found.select(F.col("block").alias("place"), "above"), "place").select(
        F.col("group").alias("key"), F.lit(0).cast("long").alias("block"), F.lit(True).alias("top"), "above", "subroot")
    return paths_to(of.groups, staged(seeds, "manifest-seeds")).mapInArrow(_proved(of.root), RESULT)


def audit_manifest(docs: DataFrame) -> DataFrame:
    return proofs(manifest(docs), docs.sparkSession)


# -- the same in SQL


def _upwards(name: str, source: str, levels: int) -> str:
    """Levels of the trees over ``source`` (g, i, d), with what stands left (l) and right (r) of a node in its run; a tree
    ends at the level where one node remains (c = 1)."""

    def level(k: int, rows: str) -> str:
        run = f"(PARTITION BY g, i // {FAN} ORDER BY i ROWS BETWEEN"
        return f"""{name}{k} AS MATERIALIZED (SELECT g, i, d, count(*) OVER (PARTITION BY g) AS c,
            coalesce(string_agg(d, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(d, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {rows})"""

    made = [level(0, source)]
    made += [level(k + 1, f"(SELECT g, i // {FAN} AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM {name}{k} WHERE c > 1 GROUP BY 1, 2)") for k in range(levels)]
    ends = " UNION ALL ".join(f"SELECT g, d FROM {name}{k} WHERE c = 1" for k in range(levels + 1))
    return ", ".join([*made, f"{name}_roots AS MATERIALIZED ({ends})"])


def _sql(levels: int = 6, tops: int = 3) -> str:
    """For up to 8 ** 6 rows in each of up to 8 ** 3 groups."""
    field = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"
    head = " || ".join(field(x) for x in FIELDS[:-1])
    changed = f"translate({field('text')}, '{UPPER}', '{LOWER}')"
    steps = "list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    crc = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, t.steps[(xor(c, b) & 255) + 1])))"
    text = f"""WITH t AS MATERIALIZED (SELECT {steps} AS steps),
        leaves AS MATERIALIZED (SELECT doc_id, lang AS g, sha256({head} || {field('text')}) AS d,
            CASE WHEN {crc} % 3 = 0 THEN sha256({head} || {changed}) END AS x FROM documents, t),
        n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM leaves),
        {_upwards('a', 'n', levels)},
        m AS MATERIALIZED (SELECT g AS lang, d, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, 0 AS g FROM a_roots),
        {_upwards('b', 'm', tops)},
        p0 AS (SELECT n.doc_id, n.d AS leaf, m.d AS subroot, coalesce(n.x, n.d) AS f, '' AS p, n.g, n.i, m.i AS j
            FROM n JOIN m ON n.g IS NOT DISTINCT FROM m.lang)"""
    ways = [("a", k, "p.g", f"p.i // {FAN**k}") for k in range(levels)] + [("b", k, "0", f"p.j // {FAN**k}") for k in range(tops)]
    for at, (name, k, g, i) in enumerate(ways):
        text += f""", p{at + 1} AS (SELECT p.doc_id, p.leaf, p.subroot,
            CASE WHEN s.d IS NULL THEN f ELSE sha256(s.l || f || s.r) END AS f, p || coalesce(s.l || s.r, '') AS p, p.g, p.i, p.j
            FROM p{at} p LEFT JOIN {name}{k} s ON s.g IS NOT DISTINCT FROM {g} AND s.c > 1 AND s.i = {i})"""
    return text + f""" SELECT doc_id, leaf, subroot, b_roots.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = b_roots.d AS verified
        FROM p{len(ways)}, b_roots"""


@query("op11_manifest", _sql())
def op11_manifest(spark, sf_dir):
    return audit_manifest(table(spark, sf_dir, "documents"))
