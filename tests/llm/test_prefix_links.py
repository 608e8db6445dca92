"""Last links of near duplicates: the prefix filter against all pairs, and its work on texts of one template."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import brute_classes
from tidemill.llm import neardup


def templated(n, changed, draw, width=300):
    base = [f"w{k}" for k in range(width)]
    out = []
    for k in range(n):
        own = list(base)
        for place in draw.sample(range(width), changed):
            own[place] = f"n{k}x{place}"
        out.append(" ".join(own))
    return out


def written(spark, path, texts):
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(path)
    return spark.read.parquet(path)


def overlap(x, y):
    same = len(np.intersect1d(x, y))
    return same >= 0.8 * (len(x) + len(y) - same)


def test_first_shared_unit_lies_in_both_prefixes():
    draw = np.random.default_rng(11)
    counts = draw.integers(1, 1000, neardup.COUNTS)
    met = 0
    for _ in range(1000):
        pool = draw.permutation(2000)[: draw.integers(4, 160)].astype(np.int32)
        bags = [np.sort(draw.permutation(np.concatenate([pool, draw.integers(3000, 9000, 2, dtype=np.int32)]))[: max(1, int(len(pool) * draw.uniform(0.85, 1)))]) for _ in range(2)]
        bags = [np.unique(b) for b in bags]
        sizes = np.array([len(b) for b in bags])
        p = neardup.prefixes(np.repeat([0, 1], sizes), np.concatenate(bags), sizes, counts)
        if overlap(*bags):
            met += 1
            x, y = (0, 1) if sizes[0] <= sizes[1] else (1, 0)
            rows = list(zip(p.owner, p.unit, p.cell, p.at, p.limit, p.small))
            ask = {(u, c): (at, limit) for own, u, c, at, limit, small in rows if own == x and small}
            told = {(u, c): (at, limit) for own, u, c, at, limit, _ in rows if own == y}
            need = neardup.least_shared(sizes.sum())
            both = [(ask[k], told[k]) for k in ask.keys() & told.keys()]
            assert any(min(sizes[x] - a[0], sizes[y] - b[0]) >= need and sizes[y] <= a[1] and sizes[x] <= b[1] for a, b in both)
    assert met > 50


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 3, "CHUNK": 5, "PAIRS": 7}])
def test_last_links_find_all_components(spark, monkeypatch, sizes):
    """Every link from nothing: no bands, no stars, so components come from the filter alone."""
    for name, value in sizes.items():
        monkeypatch.setattr(neardup, name, value)
    draw = random.Random(17)
    bags = []
    for _ in range(12):
        base = draw.sample(range(10**6), 60)
        for _ in range(8):
            own = draw.sample(base, draw.randrange(50, 61)) + [draw.randrange(10**6, 10**8) for _ in range(draw.randrange(0, 9))]
            bags.append(sorted(set(own)))
    root = list(range(len(bags)))
    for a in range(len(bags)):
        for b in range(a):
            if overlap(np.array(bags[a]), np.array(bags[b])) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    monkeypatch.setattr(neardup, "_likely", lambda pairs, nodes: pairs)
    frame = spark.createDataFrame(list(enumerate(bags)), "node long, units array<int>")
    none = spark.createDataFrame([], "node long, root long")
    found = {r.node: r.root for r in neardup._last_links(frame.select("node"), None, frame, none).collect()}
    assert {k: found.get(k, k) for k in range(len(bags))} == dict(enumerate(root))
    assert len(set(root)) > 12


def test_templated_texts_are_not_compared_with_each_other(spark, tmp_path, monkeypatch):
    """Texts of one template below 0.8: comparisons do not grow with all pairs."""
    compared, real = [0], neardup.staged

    def watched(frame, label):
        out = real(frame, label)
        if label == "near-blocks":
            asks = F.col("asks").cast("long")
            sizes = out.groupBy("meet", "part", "block", "chunk").agg((F.sum(asks) * F.sum(1 - asks)).alias("pairs"))
            compared[0] += sizes.agg(F.sum("pairs")).first()[0] or 0
        return out

    monkeypatch.setattr(neardup, "staged", watched)
    texts = dict(enumerate(templated(400, 9, random.Random(5))))
    texts |= {1000 + k: t for k, t in enumerate(templated(40, 2, random.Random(6), width=200))}
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(written(spark, str(tmp_path / "t"), texts)).collect()}
    assert found == brute_classes(texts)
    assert len({found[k] for k in range(400)}) == 400
    assert compared[0] < 10 * 400


def test_bags_differ_in_as_many_units_as_their_sketches_in_bits():
    draw = np.random.default_rng(3)
    for size in (1, 5, 40, 3000):
        pool = draw.integers(-(2**31), 2**31, size + 20).astype(np.int32)
        bags = [np.unique(draw.permutation(pool)[:size]) for _ in range(2)] + [np.empty(0, np.int32)]
        sketch = neardup.sketches(np.repeat([0, 1, 2], [len(b) for b in bags]), np.concatenate(bags), 3)
        for a, b in ((0, 1), (0, 2), (1, 1)):
            bits, units = neardup.differing_bits(sketch[[a]], sketch[[b]])[0], len(np.setxor1d(bags[a], bags[b]))
            assert bits <= units and bits % 2 == units % 2


def test_bags_below_the_wanted_overlap_are_not_paired(spark, monkeypatch):
    """Many bags of one pool that share first units but overlap too little: pairs to confirm don't grow with all pairs."""
    paired, real = [0], neardup.staged

    def watched(frame, label):
        out = real(frame, label)
        paired[0] += out.count() if label == "near-pairs" else 0
        return out

    monkeypatch.setattr(neardup, "staged", watched)
    monkeypatch.setattr(neardup, "_likely", lambda pairs, nodes: pairs)
    draw = random.Random(23)
    pool = draw.sample(range(10**8), 124)
    bags = [sorted(draw.sample(pool, 100)) for _ in range(150)]
    bags += [sorted([*bags[0][1:], 10**9]), sorted([*bags[0][2:], 10**9, 10**9 + 1])]
    links = [(a, b) for a in range(len(bags)) for b in range(a) if overlap(np.array(bags[a]), np.array(bags[b]))]
    frame = spark.createDataFrame(list(enumerate(bags)), "node long, units array<int>")
    found = {r.node: r.root for r in neardup._last_links(frame.select("node"), None, frame, spark.createDataFrame([], "node long, root long")).collect()}
    assert {a for a, _ in links} <= found.keys() and all(found[a] == found.get(b, b) for a, b in links)
    assert paired[0] < 5 * len(bags)


def test_components_end_with_stars(spark, monkeypatch):
    """The round that makes the last star is the last round."""
    from tidemill.llm import components as C

    rounds, real = [0], C.staged

    def watched(frame, label):
        rounds[0] += 1
        return real(frame, label)

    monkeypatch.setattr(C, "staged", watched)
    links = [(7, 3), (9, 3), (3, 3), (12, 11), (12, 11)]
    found = C.components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(7, 3), (9, 3), (12, 11)] and rounds[0] == 1
    chain = C.components(spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long"))
    assert sorted(map(tuple, chain.collect())) == [(k, 0) for k in range(1, 41)]


def test_a_round_of_components_reads_written_links(spark, tmp_path, monkeypatch):
    """Links that are not written are compared again by each branch of a round, and their plan fills the driver."""
    plans, whole = [], neardup.components

    def noted(links):
        plans.append(links._jdf.queryExecution().optimizedPlan().toString())
        return whole(links)

    monkeypatch.setattr(neardup, "components", noted)
    texts = dict(enumerate(templated(12, 3, random.Random(5), 120) + ["a b c d e f g"] * 2))
    docs = written(spark, str(tmp_path / "docs"), texts)
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert found == brute_classes(texts)
    assert plans and not any("MapInArrow" in plan or "Join" in plan for plan in plans)


def test_counts_of_units_do_not_pass_as_rows(spark, monkeypatch):
    """262,144 counts are 4 MB as Arrow buffers; as rows they took a hundred times that of the driver."""
    monkeypatch.setattr(type(spark.range(1)), "toPandas", lambda self: pytest.fail("rows in the driver"))
    bags = spark.createDataFrame([(1, [5, 6, 6]), (2, [6])], "node long, units array<int>")
    counts = neardup._unit_counts(bags)
    assert counts.sum() == 4 and counts[neardup._place(np.array([6], np.int32))[0]] >= 3
    assert neardup._unit_counts(bags.limit(0)).sum() == 0
