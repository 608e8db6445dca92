"""The pipeline against brute force over its own stages, and on odd tables."""

import corpus_pipeline
from tests.llm.test_operators import DOCS, brute_base, brute_classes, words


def test_pipeline_keeps_what_the_rules_keep(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    classes = brute_classes(docs)
    lettered = {k for k, t in docs.items() if any(c.isalpha() for c in t)}
    whole = {k for k, t in docs.items() if not any(" ".join(i) in " ".join(words(t)) for i in items)}
    expected = {k for k in lettered & whole if classes[k] == k}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(found) <= {k for k in lettered if classes[k] == k}
    assert len(expected - set(found)) <= 0.02 * len(expected) and set(found) <= whole
    assert all(r.exact for r in found.values())
    assert any(brute_base(docs[k]) for k in found)


def test_stages_keep_columns_and_stand_empty_tables(spark, tmp_path, sf_dir):
    rows = [(None, None, None, None, None, None, None), (1, "", None, None, None, None, None), (2, "the same text of more than five words", "en", "s", 1, 0.5, "x")] * 2
    for k, table in enumerate((rows, [])):
        docs = spark.createDataFrame(table, DOCS)
        for name, stage in corpus_pipeline.STAGES:
            path = f"{tmp_path}/{k}-{name}"
            docs.write.parquet(path)
            before, docs = spark.read.parquet(path), stage(spark, spark.read.parquet(path), sf_dir)
            assert name == "tokens" or docs.columns == before.columns
        assert docs.count() == (1 if table else 0)
