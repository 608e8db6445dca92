"""SimHash against plain loops over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from tidemill.llm import simhash


def fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in hashes) > len(hashes))


def groups(marks):
    """The smallest mark reachable from each."""
    marks, root = sorted(set(marks)), {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for k, a in enumerate(marks):
        for b in marks[:k]:
            if (a ^ b).bit_count() <= 3 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {m: find(m) for m in marks}


def expected(rows):
    marks = [fingerprint(r.text) for r in rows]
    of = groups(marks)
    least = {}
    for r, m in zip(rows, marks, strict=True):
        if r.doc_id is not None:
            least[of[m]] = min(least.get(of[m], r.doc_id), r.doc_id)
    return sorted(((r.doc_id, f"{m:016x}", least.get(of[m])) for r, m in zip(rows, marks, strict=True)), key=repr)


def got(frame):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in frame.collect()), key=repr)


def test_odd_rows_and_splits(odd_documents):
    want = expected(odd_documents.collect())
    assert got(simhash.near_duplicates(odd_documents.repartition(1))) == want
    assert got(simhash.near_duplicates(odd_documents.repartition(7))) == want
    assert got(simhash.near_duplicates(odd_documents.limit(0))) == []


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = got(simhash.near_duplicates(docs))
    assert found == expected(docs.collect())
    assert sum(a != c for a, _, c in found) > 10


@pytest.fixture(scope="module")
def marks():
    """Random numbers, chains of neighbours at 3 bits, a dense ball and both ends."""
    draw = random.Random(5)
    found = {draw.getrandbits(64) for _ in range(300)} | {0, 1, 7, 15, (1 << 64) - 1, (1 << 64) - 8}
    at = draw.getrandbits(64)
    for _ in range(200):
        at ^= sum(1 << k for k in draw.sample(range(64), 3))
        found.add(at)
    at = draw.getrandbits(64)
    for _ in range(400):
        found.add(at ^ sum(1 << k for k in draw.sample(range(64), draw.randint(1, 3))))
    return sorted(found)


@pytest.mark.parametrize("parts, tile", [(1, 4096), (1, 16), (2, 4096), (2, 8), (4, 64), (8, 4096)])
def test_tiles_lose_no_link(spark, marks, parts, tile):
    signed = np.array(marks, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x,) for x in signed], "mark long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.node_links(nodes, parts=parts, tile=tile).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {m: find(m) for m in marks} == groups(marks)


def test_a_pair_of_tiles_tells_fewer_links_than_numbers():
    ball = np.unique(np.array([1 << k for k in range(64)] + [(1 << k) | (1 << j) for k in range(64) for j in range(k)], np.uint64))
    left, right = simhash.tile_links(ball, ball, True)
    assert len(left) == len(ball) - 1 and (np.bitwise_count(left ^ right) <= 3).all()


def test_skipped_tiles_lie_beyond_the_radius():
    """Every step of counts within the radius is kept, one of two opposite ones."""
    for parts in simhash.PARTS:
        width = 128 ** np.arange(parts)
        steps = simhash.near_counts(parts)
        want = set()
        for _ in range(3000):
            d = np.zeros(parts, int)
            for _ in range(random.randint(0, 3)):
                d[random.randrange(parts)] += random.choice((-1, 1))
            want.add(abs(int((d * width).sum())))
        assert want <= set(steps) and len(steps) == len(set(steps))


def test_hashes_are_the_published_ones():
    draw = np.random.default_rng(3)
    data = draw.integers(0, 256, 60_000, dtype=np.uint8)
    starts = draw.integers(0, 50_000, 8_000)
    ends = starts + np.minimum(draw.integers(0, 130, 8_000), 9_000)
    spans = simhash.xxh64(data, np.append(starts, 0), np.append(ends, 60_000))
    raw = data.tobytes()
    assert spans.tolist() == [xxhash.xxh64_intdigest(raw[a:b], 42) for a, b in zip([*starts, 0], [*ends, 60_000], strict=True)]
