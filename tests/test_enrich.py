import json
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemill.operators import enrich as E

# the scorers below travel with their code: workers do not have this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POSTS = [(1, ["75", "36"]), (2, ["zz"]), (3, []), (4, None), (5, ["75", "75b"]), (6, [None, "36"])]
PARENTS = {1: "1", 2: "", 3: "", 4: "", 5: "1,2", 6: "1"}
STATUS = {1: "ok", 2: "unmatched", 3: "ok", 4: "ok", 5: "ok", 6: "ok"}


def frames(spark):
    posts = spark.createDataFrame(POSTS, "k int, sub_industry_id array<string>")
    entries = spark.createDataFrame([("75", "1"), ("36", "1"), ("75b", "2"), (None, "9")], "id string, parent_id string")
    return posts, entries


@pytest.mark.parametrize("strategy", ["inline", "join", "auto"])
def test_lookup(spark, strategy):
    posts, entries = frames(spark)
    got = E.lookup_parents(posts, entries, ["k"], strategy=strategy).collect()
    assert {r.k: r.parent_id for r in got} == PARENTS
    assert {r.k: r.enrich_status for r in got} == STATUS
    assert {r.k: r.sub_industry_id for r in got}[1] == "36,75"


def test_strategies_agree_on_skewed_ids(spark):
    rnd = random.Random(3)
    data = [
        (i, ["hot"] + [str(rnd.randint(0, 400)) for _ in range(rnd.randint(0, 6))]) for i in range(2000)
    ]
    posts = spark.createDataFrame(data, "k int, sub_industry_id array<string>")
    dim = [(str(i), str(i % 7)) for i in range(300)] + [("hot", "h"), ("5", "second parent")]
    entries = spark.createDataFrame(dim, "id string, parent_id string")
    results = [
        {tuple(r) for r in E.lookup_parents(posts, entries, ["k"], strategy=s).collect()}
        for s in ("inline", "join")
    ]
    parents = {}
    for i, p in dim:
        parents.setdefault(i, set()).add(p)
    expected = {
        (k, ",".join(sorted(ids)), ",".join(sorted(set().union(*(parents.get(i, set()) for i in ids)))), "ok")
        for k, ids in data
    }
    assert results[0] == results[1] == expected


def test_large_dimensions_are_joined(spark, monkeypatch):
    posts, entries = frames(spark)
    monkeypatch.setattr(E, "MAX_INLINE_ENTRIES", 2)
    got = E.lookup_parents(posts, entries, ["k"])
    assert "Subquery" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.k: r.parent_id for r in got.collect()} == PARENTS
    with pytest.raises(ValueError, match="too large"):
        E.lookup_parents(posts, entries, ["k"], strategy="inline")


def test_inline_table_stays_out_of_the_rows(spark):
    posts, entries = frames(spark)
    computed = posts.select("k", F.array_distinct("sub_industry_id").alias("sub_industry_id"))
    found = E.lookup_parents(computed.filter("k > 0"), entries, ["k"], strategy="inline")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "AS _table" not in plan and "Join" not in plan.split("Subquery")[0]


def test_empty_dimension(spark):
    posts, entries = frames(spark)
    for strategy in ("inline", "join"):
        got = E.lookup_parents(posts, entries.filter("false"), ["k"], strategy=strategy).collect()
        assert {r.parent_id for r in got} == {""} and len(got) == len(POSTS)


def test_lookup_from_json(spark):
    messages = spark.createDataFrame(
        [(1, '{"industry_1":"75","industry_2":"75b"}'), (2, '{"industry_3":"zz"}'), (3, "broken")],
        "k int, value string",
    )
    got = E.lookup_from_json(messages, frames(spark)[1], ["k"]).collect()
    assert {r.k: json.loads(r.value)["parent_id"] for r in got} == {1: "1,2", 2: "", 3: ""}


def _flaky_scorer():
    """Fails once for texts with 'once', always for 'never', raises for a
    batch holding 'crash' and answers others."""
    seen = set()

    def score(texts):
        if any("crash" in t for t in texts):
            raise OSError("service down")
        replies = []
        for t in texts:
            good = "never" not in t and ("once" not in t or t in seen)
            seen.add(t)
            replies.append('{"msg":"成功","data":[{"7":1,"3":1}]}' if good else None)
        return replies

    return score


def test_classify_attempts_and_status(spark):
    texts = ["fine", "once", "never", "", None]
    posts = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, post_content string").coalesce(1)
    got = {r.i: r for r in E.classify(posts, _flaky_scorer, max_attempts=3).collect()}
    assert [got[i].classify_status for i in range(5)] == ["ok", "ok", "failed", "skipped", "skipped"]
    assert [got[i].attempts for i in range(5)] == [1, 2, 3, 0, 0]
    assert got[0].sub_industry_id == ["3", "7"] and got[2].sub_industry_id is None


def _random_scorer():
    import random

    return lambda texts: [
        json.dumps({"msg": "成功", "data": [{str(random.randint(0, 99)): 1}]}, ensure_ascii=False)
        for _ in texts
    ]


def test_join_reads_one_answer_of_the_model(spark):
    posts = spark.range(300).select("id", F.lit("text").alias("post_content"))
    entries = spark.range(100).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("p"), "id").alias("parent_id"))
    scored = E.classify(posts, _random_scorer)
    found = E.lookup_parents(scored, entries, ["id"], strategy="join", stage=True)
    assert all(r.parent_id == f"p{r.sub_industry_id}" for r in found.collect())


def test_failing_service_loses_no_rows(spark):
    posts = spark.range(50).select("id", F.concat(F.lit("crash "), "id").alias("post_content"))
    scored = E.classify(posts, _flaky_scorer, max_attempts=2, concurrency=3)
    entries = frames(spark)[1]
    found = E.lookup_parents(scored, entries, ["id"])
    good, failed = E.split_failures(found)
    assert (good.count(), failed.count()) == (0, 50)
    assert {r.attempts for r in failed.collect()} == {2}


def _closing_scorer():
    class Client:
        def __call__(self, texts):
            return ['{"msg":"成功","data":[{}]}' for _ in texts]

        def close(self):
            Client.closed = True

    return Client()


def test_client_with_close(spark):
    posts = spark.createDataFrame([("a",)], "post_content string")
    assert E.classify(posts, _closing_scorer).first().sub_industry_id == []


def test_whitelist_filter(spark):
    posts, _ = frames(spark)
    assert sorted(r.k for r in E.keep_whitelisted(posts).collect()) == [1, 5, 6]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("strategy", ["inline", "join", "auto", "reduced"])
def test_equal_and_null_keys_are_posts_of_their_own(spark, monkeypatch, strategy, ansi):
    posts = spark.createDataFrame(
        [("r1", ["a"]), ("r1", ["b"]), (None, ["a"]), ("r2", None), ("r2", ["z"])], "rowkey string, sub_industry_id array<string>"
    )
    rows = [("a", "P"), ("b", "Q"), *[(f"x{k}", "R") for k in range(8)]]
    entries = spark.createDataFrame(rows, "id string, parent_id string")
    if strategy == "reduced":
        monkeypatch.setattr(E, "MAX_INLINE_ENTRIES", 5)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = E.lookup_parents(posts, entries, strategy="auto" if strategy == "reduced" else strategy)
        got = sorted((r.rowkey or "", r.parent_id, r.enrich_status) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got == [("", "P", "ok"), ("r1", "P", "ok"), ("r1", "Q", "ok"), ("r2", "", "ok"), ("r2", "", "unmatched")]
