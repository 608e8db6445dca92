"""The manifest against a tree built row by row."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = ["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (row.doc_id, row.source, row.lang, row.n_chars, text)]
    return h(*fields)


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """The root, and for each node what stands left and right of it on every level."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = nodes[place // 8 * 8 : place // 8 * 8 + 8]
            ways[k].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
        nodes = [h(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        at = [place // 8 for place in at]
    return nodes[0], ways


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.lang, []).append(row)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        built[name] = (own, *tree([leaf(r, r.text) for r in own]))
    root, tops = tree([built[name][1] for name in names])
    found = []
    for name, top in zip(names, tops, strict=True):
        own, subroot, ways = built[name]
        for row, way in zip(own, ways, strict=True):
            proof = h(*[a + b for a, b in way + top])
            hit = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0
            end = leaf(row, lower(row.text) if hit else row.text)
            for a, b in way + top:
                end = h(a, end, b)
            found.append((row.doc_id, leaf(row, row.text), subroot, root, proof, end, end == root))
    return sorted(found, key=repr)


def got(frame):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def test_odd_rows(odd_documents):
    assert got(manifest.audit_manifest(odd_documents)) == expected(odd_documents.collect())


def test_one_row_and_none(odd_documents):
    one = odd_documents.where("doc_id = 4")
    rows = got(manifest.audit_manifest(one))
    assert rows == expected(one.collect()) and rows[0][1] == rows[0][3] and rows[0][4] == h()
    assert manifest.audit_manifest(odd_documents.limit(0)).collect() == []


def test_several_tiers_of_groups_and_rows(spark):
    """A group of three subtrees, 600 groups (two subtrees above), partly filled ends."""
    many = spark.range(1300).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), F.lit("hot").alias("lang"))
    few = spark.range(2000, 2600).select(F.col("id").alias("doc_id"), F.lit("Same").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    docs = many.union(few).withColumns({"source": F.lit("s"), "n_chars": F.lit(4)})
    assert got(manifest.audit_manifest(docs)) == expected(docs.collect())


def test_result_does_not_depend_on_splits(odd_documents):
    assert got(manifest.audit_manifest(odd_documents.repartition(1))) == got(manifest.audit_manifest(odd_documents.repartition(7)))


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_fill_the_tree_and_keep_subtrees_together(levels):
    at = manifest.addresses(levels)
    assert sorted(np.concatenate(at).tolist()) == list(range(manifest.nodes_of(levels)))
    assert at[0][0] == 0
    top = levels // 2
    for number in range(8**top if top else 0):
        own = [at[d][number * 8 ** (d - top) : (number + 1) * 8 ** (d - top)] for d in range(top, levels)]
        places = np.concatenate(own)
        assert places.max() - places.min() + 1 == len(places)  # a lower half is one run


def test_a_changed_row_is_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = manifest.audit_manifest(docs).collect()
    upper = {r.doc_id for r in docs.collect() if lower(r.text) != r.text}
    assert {r.doc_id for r in found if not r.verified} == {k for k in upper if zlib.crc32(str(k).encode()) % 3 == 0}
