"""The filter audit against plain loops."""

import re
from collections import Counter
from itertools import permutations

from tidemill.llm import audit

NAMES = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(rows):
    least = {}
    for r in rows:
        if r.doc_id is not None:
            least[r.text or ""] = min(least.get(r.text or "", r.doc_id), r.doc_id)
    for r in rows:
        text = r.text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        own = "A" * (len(words) < 200)
        own += "B" * (100 * len(set(words)) < 50 * len(words))
        own += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text))
        own += "D" * bool(re.search("[#$%&*|]", text))
        own += "E" * (r.doc_id is not None and r.doc_id > least[text])
        yield r, own


def expected(rows, labels):
    good = {r.doc_id for r in labels if r.quality == 1} - {None}
    toxic = {r.doc_id for r in labels if r.toxic == 1} - {None}
    parts = {}
    for r, own in fails(rows):
        parts.setdefault(r.source or "", []).append((r.doc_id, own))
    found = []
    for part, docs in parts.items():
        shares, lines = Counter(), []
        for order in permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                shares[name] += len(gone)
                redundant = sum(name in own and bool(set(own) & set(order[: step - 1])) for _, own in docs)
                lines.append((name, ("".join(order), step, len(left), len(gone), redundant, sum(own == name for _, own in docs), sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone))))
        found += [(part, *line, shares[name]) for name, line in lines]
    return sorted(found)


def got(frame):
    return sorted(tuple(r[n] for n in NAMES) for r in frame.collect())


def test_odd_rows_labels_and_splits(spark, odd_documents):
    labels = spark.createDataFrame([(6, 1, 0, "x"), (6, 0, 1, None), (10, None, 1, None), (None, 1, 1, None), (99, 1, 1, None)], "doc_id long, quality int, toxic int, part string")
    want = expected(odd_documents.collect(), labels.collect())
    assert got(audit.filter_audit(odd_documents, labels)) == want
    assert got(audit.filter_audit(odd_documents.repartition(1), labels)) == want
    assert got(audit.filter_audit(odd_documents, labels.limit(0))) == expected(odd_documents.collect(), [])
    assert got(audit.filter_audit(odd_documents.limit(0), labels)) == []


def test_matrix_has_each_documents_words(spark, odd_documents):
    """Row sums and entries of the shards, spelled out by the dictionary, are the words of the texts."""
    import numpy as np

    shards = audit.local_shards(odd_documents.where("doc_id IS NOT NULL"))
    numbers = audit.numbered_words(shards)
    terms = audit.dictionary(numbers)
    spelled = {r.term: bytes(r.word).decode() for r in terms.collect()}
    assert len(spelled) == len(set(spelled.values())) == terms.count()
    found = Counter()
    for shard in audit.term_matrix(shards, numbers).collect():
        begins, cells, counts = (np.frombuffer(x, t) for x, t in ((shard.begins, np.int64), (shard.terms, np.int64), (shard.counts, np.uint32)))
        for k, doc in enumerate(shard.doc_id):
            own = {spelled[t]: c for t, c in zip(cells[begins[k] : begins[k + 1]].tolist(), counts[begins[k] : begins[k + 1]].tolist(), strict=True)}
            found[(doc, tuple(sorted(own.items())))] += 1
    want = Counter((r.doc_id, tuple(sorted(Counter(re.findall("[^\x20\x09-\x0d]+", r.text or "")).items()))) for r in odd_documents.where("doc_id IS NOT NULL").collect())
    assert found == want


def test_texts_are_not_shuffled(odd_documents):
    plan = audit.local_shards(odd_documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    words = audit.numbered_words(audit.local_shards(odd_documents))
    assert words.columns == ["bucket", "shard", "first", "places", "fresh"]


def test_numbers_in_few_bytes():
    import numpy as np

    for top in (0, 255, 256, 65_535, 65_536, 1 << 31):
        assert audit.widened(audit.narrow(np.array([top, 1]))).tolist() == [top, 1]
    assert len(audit.narrow(np.array([255]))) == 2 and audit.widened(audit.narrow(np.empty(0, np.int64))).tolist() == []
