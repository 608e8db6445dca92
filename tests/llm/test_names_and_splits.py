"""Results do not depend on column names, on splits or on which path a size chooses."""

import pytest

from tidemill.llm import decontaminate, language, neardup

NAMES = ["__row", "row", "key", "label", "__ROW_"]


@pytest.fixture(scope="module")
def named(spark, tmp_path_factory):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = str(tmp_path_factory.mktemp("named") / "docs")
    docs.selectExpr("*", *[f"doc_id % {k + 3} AS {n}" for k, n in enumerate(NAMES)]).write.parquet(path)
    return spark.read.parquet(path)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("splits", [1, 7])
def test_near_copies_keep_columns_of_any_name(spark, named, splits):
    plain = {r.doc_id for r in neardup.representatives(named.drop(*NAMES)).collect()}
    found = neardup.representatives(named.repartition(splits))
    assert found.columns == named.columns
    assert rows(found) == rows(named.where(named.doc_id.isin(plain)))


@pytest.mark.parametrize("splits", [1, 7])
def test_both_paths_of_decontamination_keep_columns_of_any_name(spark, named, monkeypatch, splits):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    items = items.union(spark.createDataFrame([(None, None), (-1, None), (-2, "")] * 50, "item_id long, text string"))
    small = decontaminate.without_passages(named.repartition(splits), items)
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", 0)
    large = decontaminate.without_passages(named.repartition(splits), items)
    assert small.columns == large.columns == named.columns
    assert rows(small) == rows(large) and 0 < small.count() < named.count()


def test_language_learns_from_the_same_windows(spark, named):
    pieces = [
        language.training_windows(named.repartition(n), span=48, per_language=400, per_document=4, seed=3) for n in (1, 7)
    ]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        pieces.append(language.training_windows(named, span=48, per_language=400, per_document=4, seed=3))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert pieces[0] == pieces[1] == pieces[2] and len(pieces[0]) > 100
