"""Each operator against brute force on small tables, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidemill.llm import decontaminate, language, licenses, neardup, pieces, quality, secrets, sharding, topk, warc
from tidemill.llm.components import components
from tidemill.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row string"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls in every column, empty, blank and long texts, repeated rows, equal texts, clashing extra columns."""
    long = " ".join(f"word{k % 977} the" for k in range(40_000))
    texts = [None, "", " \n", "...", "the", "a b c d e f g", "a b c d e f g", "été \U0001f600 日本語", long, "x" * 5000, "cc by cc by", 'token = "abcdefghijkl0123"']
    rows = [(k, t, "en" if k % 2 else None, None, None, None, None) for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "a b c d e f g", "en", "s", 3, 1.0, "r"), (None, None, None, None, None, None, None)]
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    spark.createDataFrame(rows, DOCS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    rows, difference = compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert difference is None and rows > 0


# -- quality


def test_quality_holds_out_and_separates(spark, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").collect()}
    assert len(found) == 1000
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for k, r in found.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(found[k].predicted, v) for k, v in labels.items() if k in found and found[k].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0, None), (1, 1, 0, None), (5, 0, None, None), (None, 1, 1, None)], "doc_id long, quality int, toxic int, text string")
    assert quality.document_quality(odd, labels).count() == odd.count()
    assert {r.score for r in quality.document_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.document_quality(odd.limit(0), labels).count() == 0


def test_isotonic_is_monotone():
    draw = np.random.default_rng(1)
    x, y = draw.normal(size=300), draw.integers(0, 2, 300).astype(float)
    knots, levels = quality.isotonic(x, y)
    assert (np.diff(knots) > 0).all() and (np.diff(levels) > -0.2).all()


# -- archives


def test_archives_go_there_and_back(spark):
    big = "z\r\n\r\n" * 60
    rows = [(3, "http://a", big, 1), (1, "u\r\nx", big, 1), (2, None, big, 2), (4, None, None, 1), (5, "", "", 1), (6, "b", "é" * 49, 1), (7, "b", "é" * 49, 1), (None, "n", big, 1), (8, "c", "y" * 200_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")
    found = {r.page_id: r for r in warc.archived_pages(pages).collect()}
    assert len(found) == len(rows)
    for page, _, html, _ in rows:
        payload, r = (html or "").encode(), found[page]
        assert r.payload_bytes == len(payload) and r.payload_digest == hashlib.sha256(payload).hexdigest()
        again = html == big and page != 1
        assert (r.record_type, r.refers_to) == (("revisit", 1) if again else ("response", None))
        assert r.payload is None if again else bytes(r.payload) == payload
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_normaliser_reads_one_and_many_members():
    records = [warc.page_record(k, None, b"x" * k, "d", None) for k in range(50)]
    one = zlib.compressobj(6, zlib.DEFLATED, 31)
    streams = [one.compress(b"".join(records)) + one.flush()]
    streams.append(b"".join((p := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(r) + p.flush() for r in records))
    for stream in streams:
        cut = [stream[k : k + 7] for k in range(0, len(stream), 7)]
        assert [r for _, r in warc.split_records(warc.inflated(iter(cut)))] == records
    with pytest.raises(ValueError):
        list(warc.split_records(warc.inflated(iter([streams[0][:-40]]))))


# -- top k


def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(2)
    vectors = np.round(draw.normal(size=(240, 6)), 2)
    vectors[50:90] = vectors[50]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    rows += [(500, None), (600, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (700, [float("nan")] * 6), (800, [float("inf")] * 6), (None, [1.0] * 6), (900, [1.0, 2.0]), (901, [3.0, 1.0]), (1000, []), (1100, [1e9] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0, pivots=5, block=16)
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    whole = {k: [int(np.floor(1024 * x)) for x in v] for k, v in rows if k is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    for q in [k for k in whole if k % 100 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), k) for k, v in whole.items() if k != q and len(v) == len(whole[q]))
        assert got.pop(q, []) == [(n + 1, k, -s) for n, (s, k) in enumerate(scores[:10])]
    assert not got
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0

@pytest.mark.parametrize("rows", [8, 11, 12, 60])
def test_top_k_of_one_block_with_the_queries_own_rows(spark, rows):
    """The own row, which is left out, takes no place among the best of its block."""
    draw = np.random.default_rng(rows)
    vectors = draw.normal(size=(rows, 4))
    frame = spark.createDataFrame([(100 * k, [float(x) for x in v]) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0, pivots=1).collect()
    v = np.floor(vectors * 1024).astype(np.int64)
    want = set()
    for n in range(rows):
        order = [x for x in sorted(range(rows), key=lambda x: (-int(v[x] @ v[n]), x)) if x != n][:10]
        want |= {(100 * n, r, 100 * x, int(v[x] @ v[n])) for r, x in enumerate(order, 1)}
    assert sorted(map(tuple, found)) == sorted(want)


# -- licenses


def test_license_base_equals_brute_force(spark, docs, odd):
    for frame in (docs, odd):
        texts = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in frame.select("doc_id", "text").collect()), key=str)
        found = sorted(((r.doc_id is None, r.doc_id or 0, r) for r in licenses.scan_licenses(frame).collect()), key=lambda x: x[:2])
        expected = defaultdict(list)
        for none, k, text in texts:
            own, places, labels = words(text), [], set()
            for phrase, label in licenses.BASE:
                p = phrase.split()
                at = [i for i in range(len(own)) if own[i : i + len(p)] == p]
                places += at
                labels |= {label} if at else set()
            expected[none, k].append((len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
        for none, k, r in found:
            row = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
            expected[none, k].remove(row)
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert not any(expected.values())


def test_license_notices_are_labelled(spark):
    texts = ["x Licensed under the Apache License, Version 2.0. y", "Released under the MIT License.", "we like the mit and its license", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.scan_licenses(frame).collect()}
    assert found == {0: "apache-2.0", 1: "mit", 2: "", 3: ""}
    assert licenses.scan_licenses(frame.limit(0)).count() == 0


def test_license_notices_side_by_side_are_all_labelled(spark):
    mit, bsd, apache = (max((t for t in licenses.TEMPLATES if t[0] == label), key=lambda t: len(t[2].split()))[2] for label in ("mit", "bsd", "apache-2.0"))
    vocabulary = " x ".join(sorted({w for t in licenses.TEMPLATES for w in t[2].split()}, reverse=True))
    altered = apache.replace("compliance", "accordance").replace("except", "unless").replace("file", "code").replace("use", "copy")
    texts = [" and more ".join([mit, bsd, apache]), f"{vocabulary} x {apache} x {vocabulary}", f"{mit} x licensed under the apache license version 2 0", vocabulary, altered]
    texts += ["other words"] * 5 + [mit] * 3 + [apache] * 4
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.scan_licenses(frame).collect()}
    assert [found[k] for k in range(5)] == ["apache-2.0,bsd,mit", "apache-2.0", "apache-2.0,mit", "", "apache-2.0"]


# -- near duplicates


@pytest.fixture
def shifting_splits(spark, monkeypatch):
    """File splits that change with every written table, as they do when executors come or go."""
    count, real = [0], neardup.staged

    def shifted(frame, label):
        written = real(frame, label)
        count[0] += 1
        spark.conf.set("spark.sql.files.minPartitionNum", 1 if count[0] % 2 else 64)
        return written

    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    spark.conf.set("spark.sql.files.minPartitionNum", 64)
    for module in (neardup, decontaminate):
        monkeypatch.setattr(module, "staged", shifted)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_keep_their_numbers_when_splits_change(spark, shifting_splits, monkeypatch, tmp_path):
    draw = random.Random(4)
    texts = {}
    for k in range(200):
        own = [f"w{draw.randrange(10**6)}" for _ in range(100)]
        texts[2 * k], texts[2 * k + 1] = " ".join(own), " ".join([*own[:-1], "end"])
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == {k: k - k % 2 for k in texts}
    assert sorted(r.doc_id for r in neardup.representatives(docs).collect()) == list(range(0, 400, 2))
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", 0)
    benchmark = spark.createDataFrame([(1, " ".join(texts[6].split()[:30]))], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.contaminated(docs, benchmark).collect()) == [6, 7]
    assert sorted(set(texts) - {r.doc_id for r in decontaminate.without_passages(docs, benchmark).collect()}) == [6, 7]



def bags(texts):
    out = {}
    for k, t in texts.items():
        w = words(t)
        out[k] = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])
    return out


def brute_classes(texts):
    root, own, by, same = {k: k for k in texts}, bags(texts), defaultdict(list), defaultdict(list)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, c in own.items():
        for g in c:
            by[g].append(k)
    pairs = {(a, b) for group in by.values() for i, b in enumerate(group) for a in group[:i]}
    for a, b in pairs:
        m = sum((own[a] & own[b]).values())
        if m >= 0.8 * (own[a].total() + own[b].total() - m):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    for k, t in texts.items():
        if t is not None:
            same[t].append(k)
    for group in same.values():
        for k in group:
            x, y = find(k), find(group[0])
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}


def test_near_duplicates_equal_brute_force(spark, docs, tmp_path):
    draw = random.Random(3)
    texts = {r.doc_id: r.text for r in docs.collect()}
    base = [f"w{draw.randrange(500)}" for _ in range(300)]
    for k in range(400):  # a large group of near copies: some pairs below the threshold
        own = list(base)
        for _ in range(draw.randrange(1, 7)):
            own[draw.randrange(300)] = f"n{draw.randrange(10**6)}"
        texts[10_000 + k] = " ".join(own)
    for k in range(300):  # a passage that many texts share
        texts[20_000 + k] = " ".join([*base[:60], *(f"q{draw.randrange(10**6)}" for _ in range(60))])
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(path)
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.read.parquet(path)).collect()}
    assert found == brute_classes(texts)


def test_near_duplicates_of_odd_rows(spark, odd):
    found = neardup.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by = defaultdict(set)
    for r in found:
        by[r.doc_id].add(r.class_id)
    assert by[5] == by[6] == {5} and by[0] == {0} and by[None] == {None, 5}
    kept = neardup.representatives(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted([-1, -1, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11])
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(5)
    hashes = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    a, b = draw.integers(1, 9, 40), draw.integers(1, 9, 40)
    found = neardup.signatures(np.repeat([0, 1], 40), np.tile(hashes, 2), np.concatenate([a, b]), 2, registers=4000)
    assert abs((found[0] == found[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(50, 60), (60, 50), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {**{k: 1 for k in range(2, 41)}, 60: 50}
    assert components(links.limit(0)).count() == 0


# -- pieces


def brute_viterbi(model, text):
    """Best sum of scores by plain dynamic programming over characters, longer last pieces first."""
    by = {p.piece: (k, p.score) for k, p in enumerate(model.pieces) if p.type in (1, 4)}
    unknown = min(s for _, s in by.values()) - 10
    s = "▁" + text.replace(" ", "▁")
    best = [(0.0, [])] + [None] * len(s)
    for end in range(1, len(s) + 1):
        for begin in range(max(0, end - 16), end):
            if s[begin:end] in by and best[begin]:
                k, score = by[s[begin:end]]
                if best[end] is None or best[begin][0] + score > best[end][0]:
                    best[end] = (best[begin][0] + score, [*best[begin][1], k])
        if best[end] is None:
            best[end] = (best[end - 1][0] + unknown, [*best[end - 1][1], *(3 + b for b in s[end - 1].encode())])
    return best[-1][1] if text else []


def test_pieces_equal_brute_force_and_round_trip(docs, odd):
    from sentencepiece import sentencepiece_model_pb2 as messages

    model = messages.ModelProto()
    model.ParseFromString(open(pieces.MODEL, "rb").read())
    texts = [t for t in (r.text for r in docs.limit(40).collect()) if len(t) < 4000] + ["", " ", "  a  b ", "été 日本語 \U0001f9ff x", "tab\tnew\nline", "x" * 200]
    encoder = pieces.Encoder(pieces.read_vocabulary())
    for own, data, offsets in pieces.text_slices(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), limit=20_000):
        ids, places = encoder.encode(data, offsets)
        back, edges = encoder.decode(ids, places)
        for k, text in enumerate(own.column("text").to_pylist()):
            assert ids[places[k] : places[k + 1]].tolist() == brute_viterbi(model, text)
            assert back[edges[k] : edges[k + 1]].tobytes().decode() == text


def test_pieces_of_odd_rows(odd):
    encoded = pieces.encode_documents(odd).cache()
    assert encoded.filter("not exact").count() == 0 and encoded.count() == odd.count()
    back = {(r.doc_id, r.text) for r in pieces.decode_documents(encoded).collect()}
    assert back == {(r.doc_id, r.text or "") for r in odd.collect()}
    assert pieces.encode_documents(odd.limit(0)).count() == 0


# -- decontamination


def brute_tiles(text, item, least):
    text, item, used, free, covered = list(text), list(item), set(), set(range(len(item))), 0
    while True:
        best, found = least - 1, []
        for j in range(len(item)):
            for i in range(len(text)):
                k = 0
                while j + k in free and i + k < len(text) and i + k not in used and text[i + k] == item[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best:
                    found.append((i, j))
        if best < least:
            return covered
        for i, j in found:
            if not used & set(range(i, i + best)) and set(range(j, j + best)) <= free:
                used |= set(range(i, i + best))
                free -= set(range(j, j + best))
                covered += best


def test_tiles_equal_brute_force():
    draw = np.random.default_rng(6)
    letters = draw.integers(1 << 40, 1 << 62, 5, dtype=np.uint64)
    for _ in range(200):
        text, item, least = letters[draw.integers(0, 5, draw.integers(1, 50))], letters[draw.integers(0, 5, draw.integers(1, 25))], int(draw.integers(1, 5))
        assert decontaminate.tiles(text.copy(), item.copy(), least)[0] == brute_tiles(text, item, least)


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_decontamination_catches_reordered_passages(spark, odd, monkeypatch, tmp_path, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", bound)
    item = [f"b{k}" for k in range(40)]
    filler = [f"f{k}" for k in range(200)]
    texts = [
        " ".join([*filler, *item, *filler]), " ".join([*item[20:], "x", *item[:20]]).upper(), " ".join([*filler, *item[:12]]),
        " ".join(w for k in range(0, 40, 4) for w in [*item[k : k + 4], "y"]), "one two three", None, "",
    ]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(k, t, "extra") for k, t in enumerate(texts)], "doc_id long, text string, item_id string").write.parquet(path)
    docs = spark.read.parquet(path)
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, "two three"), (3, None), (4, ""), (None, "three two")], "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.covered_words) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert found == {(0, 1, 40), (1, 1, 40), (4, 2, 2)}
    assert sorted(r.doc_id for r in decontaminate.without_passages(docs, benchmark).collect()) == [2, 3, 5, 6]
    assert decontaminate.without_passages(odd, benchmark.limit(0)).count() == odd.count()
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0


# -- language


def test_language_learns_and_holds_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect()}
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(found) == len(langs) and all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in found.items())
    held = [r.lang_pred == langs[k] for k, r in found.items() if r.held_out]
    assert sum(held) / len(held) > 0.95


def test_language_slopes_equal_differences():
    pieces_ = [(bytes([97 + k % 3] * 5), "ab"[k % 2]) for k in range(6)]
    model = language.fit_language(pieces_, span=5, hidden=3, steps=1, batch=4)
    codes = np.full((5, 6), language.PAD)
    for k, (p, _) in enumerate(pieces_):
        codes[: len(p) - (k == 1), k] = list(p)[: len(p) - (k == 1)]
    target = np.array([k % 2 for k in range(6)])

    def loss():
        p = model.positions(codes)
        inside = codes != language.PAD
        return -(np.log(p[:, np.arange(6), target]) * inside).sum() / inside.sum()

    slopes = language._slopes(model, codes, target)
    values = [model.forward.inputs, model.forward.gates, model.forward.candidate, model.backward.inputs, model.backward.gates, model.backward.candidate, model.head, model.bias]
    for value, slope in zip(values, slopes):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept = value[at]
        value[at] = kept + 1e-2
        up = loss()
        value[at] = kept - 1e-2
        down = loss()
        value[at] = kept
        assert abs((up - down) / 2e-2 - slope[at]) < 0.03 * abs(slope[at]) + 1e-4


def test_language_of_odd_rows(spark, odd):
    model = language.learned_language(odd)
    found = {(r.doc_id, r.lang_pred) for r in language.predict_language(odd, model).collect()}
    assert {(k, "und") for k in (0, 1, 2, 3)} <= found and (5, "en") in found
    assert {r.lang_pred for r in language.predict_language(odd, None).collect()} == {"und"}
    assert language.recognised(odd, model, 0.0).columns == odd.columns
    assert language.predict_language(odd.limit(0), language.learned_language(odd.limit(0))).count() == 0


def test_recognised_keeps_clean_texts_without_labels_and_among_many_languages(spark):
    frame = spark.createDataFrame([(1, "some text", None), (2, "12 34", None), (3, None, None), (4, "", None)], "doc_id long, text string, lang string")
    model = language.learned_language(frame)
    assert model is None and [r.doc_id for r in language.recognised(frame, model, 0.3).collect()] == [1]
    names, zeros = [f"l{k}" for k in range(20)], np.zeros
    direction = language.Direction(zeros((257, 3), np.float32), zeros((1, 2), np.float32), zeros((1, 1), np.float32))
    for bias, kept in ((np.log(4.0), [1]), (0.0, [])):  # 0.17 for the first of twenty languages; an even share for all
        flat = language.LanguageModel(names, direction, direction, zeros((2, 20), np.float32), np.array([bias] + [0] * 19, np.float32), 48)
        assert [r.doc_id for r in language.recognised(frame, flat, 0.3).collect()] == kept


# -- shards


def test_shards_are_minimax(spark, odd, docs):
    for frame in (docs, odd):
        found = sharding.shard_by_bytes(frame).collect()
        assert len(found) == frame.count() and {r.law for r in found} == {"bytes"}
        by = defaultdict(list)
        for r in found:
            by[r.shard].append(r)
        assert all(0 <= s < 8 and sorted(r.slot for r in rows) == list(range(len(rows))) for s, rows in by.items())
        groups = defaultdict(int)
        shards = defaultdict(set)
        for r in frame.select("doc_id", "text").collect():
            groups[hashlib.md5(r.text.encode()).hexdigest() if r.text is not None else "-"] += len((r.text or "").encode()) + 1
        for r in found:
            shards[r.text_crc32].add(r.shard)
        assert all(len(s) == 1 for s in shards.values())
        sizes = [groups[k] for k in sorted(groups)]

        def needed(capacity):
            count, left = 1, capacity
            for size in sizes:
                if size > left:
                    count, left = count + 1, capacity
                left -= size
            return count

        low, high = max(sizes), sum(sizes)
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if needed(middle) <= 8 else (middle + 1, high)
        assert max(sum(r.size for r in rows) for rows in by.values()) == low
    assert sharding.shard_by_bytes(docs.limit(0)).count() == 0


# -- secrets


def brute_base(text):
    text, found = text or "", []
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [("assign", m.start(), m.end()) for m in re.finditer(assign, text, re.ASCII) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ["assign", "access", "hex"]
    return sorted(found, key=lambda x: (x[1], order.index(x[0])))


def test_secret_base_equals_brute_force(spark, odd):
    draw = random.Random(8)
    parts = ["token", "API_KEY", "passwd", "secret", "=", ":", " ", '"', "'", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "é", "K", "x", "-", "\n", "0f"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(1500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = secrets.fit_secrets(*secrets.labelled_findings(frame))
    for own, truth in ((frame, dict(enumerate(texts))), (odd.filter("doc_id is not null"), {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None})):
        for r in secrets.scan_secrets(own, model).collect():
            base = brute_base(truth[r.doc_id])
            said = [f"{k}:{a}:{b}" for k, a, b in base]
            assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
            assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, *_ in base) for kind in ("assign", "access", "hex"))
            assert [s for s in r.spans.split(",") if s and not s.startswith("model")] == said
    assert secrets.scan_secrets(frame.limit(0), None).count() == 0


def test_secret_network_learns_and_texts_are_redacted(spark):
    draw = random.Random(9)
    hexa = lambda n: "".join(draw.choices("0123456789abcdef", k=n))
    mixed = lambda n: "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n))
    texts = [f"see token = {mixed(24)} here" for _ in range(300)] + [f"call +1 555-{draw.randrange(1000, 9999)}-0{draw.randrange(99)} now" for _ in range(300)] + [f"the key is {mixed(24)} ok", f"id {hexa(32)}", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_chars", F.lit(0).cast("long"))
    model = secrets.fit_secrets(*secrets.labelled_findings(frame))
    rows = {r.doc_id: r.text for r in secrets.redact_secrets(frame, model).collect()}
    assert rows[601] == "id [secret]" and rows[602] is None and rows[603] == "" and all("[secret]" in rows[k] for k in range(300))
    assert all(rows[k] == texts[k] for k in range(300, 600)) and rows[600] == "the key is [secret] ok"


class Spotter:
    """Stands for a network that is sure of windows with a Z."""

    threshold = 0.5

    def probabilities(self, codes):
        return (codes == ord("Z")).any(axis=1).astype(float)


def model_spans(text):
    raw = text.encode()
    starts, ends, kinds = secrets.find_secrets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), Spotter())
    return [(a, b) for a, b, k in zip(starts.tolist(), ends.tolist(), kinds.tolist()) if secrets.KINDS[k] == "model"]


def test_long_candidates_are_read_to_their_end():
    for size in (33, 40, 48, 64, 65, 500):
        for at in range(size):
            own = ["q"] * size
            own[at] = "Z"
            assert model_spans(f"in {''.join(own)} x") == [(3, 3 + size)]
    assert model_spans(f"in {'q' * 500} x") == []


def test_wanted_recall_is_kept_when_probabilities_are_low():
    codes = np.tile(np.frombuffer(b"x" * secrets.WIDTH, np.uint8), (330, 1))
    model = secrets.fit_secrets(codes, np.arange(330) % 11 == 0)
    p = model.probabilities(codes)
    assert p.max() < 0.5 and (p >= model.threshold).all() and model.recall == 1 and 0.05 < model.precision < 0.15


def test_letters_and_what_stands_behind_a_base_finding_are_scored():
    assert model_spans("my kkkkZkkk here") == [(3, 11)] and model_spans("my kkkkZkk here") == []
    access = "AKIA" + "A1" * 8
    assert model_spans(f"{access}/{'Zk' * 20}") == [(0, 61)] and model_spans(f"x {access} y") == []
    assert model_spans(f"x {access}/Zk y") == [(2, 25)] and model_spans("token = ZZZZZZZZZZZZ1234") == []


def test_copies_are_one_labelled_finding(spark):
    texts = ["see 555-0000-1111 and token = abcdefghijklmnop1234"] * 300 + [f"call 555-{k}-0000 or token = mnopqrstuvwxyz{k}" for k in range(1000, 1020)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    for most in (4, 21):
        codes, y = secrets.labelled_findings(frame, most=most)
        assert len({x.tobytes() for x in codes}) == len(codes) == 2 * most and y.sum() == most


def test_secrets_are_learned_from_all_findings(spark):
    """Counts, slopes and held findings are those of all rows, also beyond the choice that gives first weights."""
    draw = random.Random(4)
    mixed = lambda n: "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n))
    texts = [f"see token = {mixed(24)} here" for _ in range(200)] + [f"wonderful number {draw.randrange(10**9, 10**10)} now" for _ in range(200)] + [None, ""]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    codes, target = secrets.labelled_findings(frame)
    assert len(codes) > 3 * 40  # distinct, and all of them with the usual bound
    few = secrets.labelled_findings(frame, most=20)
    model = secrets.fit_secrets(*few)
    z, secret, count = secrets.held_logits(frame, model)
    held = secrets.held_out(codes)
    assert count[secret == 1].sum() == target[held].sum() > 20 and count[secret == 0].sum() >= (1 - target)[held].sum() > 20
    found = np.floor(model.all_logits(codes[held & (target == 1)]) * secrets.GRID) / secrets.GRID
    assert sorted(np.repeat(z[secret == 1], count[secret == 1])) == sorted(np.clip(found, -40, 40))
    before = model.all_logits(codes)
    secrets._moved(frame, model)
    loss = lambda z: sum(np.log1p(np.exp(-np.where(target == k, 1, 0) * (2 * k - 1) * z))[(target == k) & ~held].mean() for k in (0, 1))
    assert loss(model.all_logits(codes)) < loss(before)
    whole = secrets.learned_secrets(frame, most=20)
    p = whole.probabilities(codes[held])
    assert (p[target[held] == 1] >= whole.threshold).mean() >= 0.9 and whole.precision > 0.9


def test_looked_up_logits_are_those_of_the_network():
    draw = np.random.default_rng(6)
    codes = draw.integers(0, 256, (200, secrets.WIDTH)).astype(np.uint8)
    model = secrets.fit_secrets(codes, (codes[:, 30] > 200).astype(int), epochs=1)
    for _ in range(2):
        assert np.allclose(model.all_logits(codes), model.logits(codes), atol=1e-4)
        model.embed = model.embed[::-1].copy()
    assert "_looked_up" not in model.__getstate__()
