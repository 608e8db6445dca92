import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, mark long, key string, block int"


@pytest.fixture(scope="session")
def odd_documents(spark, tmp_path_factory):
    """Nulls in every column, empty, blank and long texts, repeated rows, equal texts, extra columns with clashing names."""
    long = " ".join(f"word{k % 977} the" for k in range(40_000))
    texts = [None, "", " \n", "...", "The", "a B", "a b c d e f g", "A b c d e f g", "été \U0001f600 日本語 Été", long, "x" * 300_000, "B # c", "B # c"]
    rows = [(k, t, "en" if k % 2 else None, "s" if k % 3 else None, None if k % 4 else k, "p", 1, "k", 2) for k, t in enumerate(texts)]
    rows += [rows[6], rows[6], (6, "another text", "en", "", 1, None, None, None, None), (None, "a b c d e f g", "en", "s", 3, None, 1, None, 1), (None,) * 9]
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)
