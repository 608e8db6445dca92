import random

import pytest
from pyspark.sql import functions as F

from tests import model
from tidemill.functions import text as T
from tidemill.operators.clean import as_posts, as_results, clean_posts, strip_posts

S = "This sentence is long enough to pass the gate"

CASES = [
    (f"#sale {S} # really", f"{S} # really"),
    (f"{S} https://a.b/c http://x.y end", f"{S} http://x.y end"),
    (f"{S} Tel. 813-445-4818, Tel:99-1 tel. 5", f"{S} tel.5"),
    (f"{S} Email Address: a@b.c and mail d@e.f", f"{S} and mail d@e.f"),
    ("This sentence is long\nenough to pass the gate", "This sentence is longenough to pass the gate"),
    (f"{S} 中文\U0001f600 ok ©\U0001f1e8\U0001f1f3", f"{S} ok"),
    (f"{S} 1️⃣ 2 3", f"{S} 2 3"),
    (f"Café かな \U0001fa70 {S}", f"Café かな \U0001fa70 {S}"),
    (f"{S}. Go to www.shop.com.cn now. Second sentence stays", f"{S}.Second sentence stays"),
    (f"{S}. see www shop.com today", S),
    (f" A , B,, C . . D,. {S} ...", f"A,B,C..D,.{S}"),
    (f"{S} \\ufe0f380White board", f"{S} board"),
    ("This  sentence   is long enough to pass the gate", S),
    (f"{S}..\r\n", f"{S}.."),
    ("a" * 29, ""),
    ("a" * 30, "a" * 30),
    ("b" * 500, "b" * 500),
    ("b" * 501, ""),
    ("a" * 28 + "\U0001fa70", "a" * 28 + "\U0001fa70"),
    ("", ""),
    ("...", ""),
    ("www.foo.com", ""),
    (None, None),
]


def run(spark, texts, step):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in rows.select("i", step(F.col("t")).alias("x")).orderBy("i").collect()]


def test_cases(spark):
    assert run(spark, [c[0] for c in CASES], T.clean_post) == [c[1] for c in CASES]


def test_frame_form_equals_column_form(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, post_content string")
    all_rows = {r.i: r.post_content for r in clean_posts(rows, keep_empty=True).collect()}
    assert all_rows == {i: c[1] for i, c in enumerate(CASES)}
    kept = {r.i: r.post_content for r in clean_posts(rows).collect()}
    assert kept == {i: c[1] for i, c in enumerate(CASES) if c[1]}


FRAGMENTS = [
    "#", "#tag", "https:", "https://x.y/z", "http://q", "Tel", "Tel.", "Tel. ", "Tel:", "1-2,3", " 5",
    "Email Address:", "Email Address: ", "a@b", "\n", "\r", "\t", " ", "  ", ".", "..", ",", ",,", " , ",
    "www", "www.", ".com", ".com.cn", ".cn", "need etl website", "need etl ", "website", "�",
    "\\u", "\\u12ab", "_x", "中", "鿿", "‍", "️", "⃣", "1", "*", "☀", "©",
    "®", "é", "か", "\U0001f600", "\U0001f1e8", "\U0001fa70", "\U0001f004", "〰", "\x00",
    "\x0b", "\x1f", " ", "\u0085", " ", "word", "A", "z", "long enough words to pass the gate",
]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts(spark, seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choices(FRAGMENTS, k=rnd.randint(1, 30))) for _ in range(3000)]
    assert run(spark, texts, T.clean_post) == [model.clean_post(t) for t in texts]
    stripped = [model.strip_post(t) for t in texts]
    assert run(spark, texts, T.strip_post) == stripped
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.t for r in strip_posts(rows, "t").orderBy("i").collect()] == stripped


def test_single_pass_equals_arrays(spark):
    rnd = random.Random(7)
    pieces = [".", ",", " ", "\t", "a", "b c", "need etl website", "\x00"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(0, 15))) for _ in range(6000)]

    def by_arrays(c):
        return T.join_sentences(T.drop_website_sentences(T.split_sentences(c)))

    def by_passes(c):
        return T.tidy_sentences(T.remove_marked_sentences(T.drop_end_dots(c)))

    assert run(spark, texts, by_passes) == [x[:-1] for x in run(spark, texts, by_arrays)]


def test_split_keeps_inner_and_drops_trailing_empties(spark):
    texts = ["", "...", "a", ".a", "a..b", "a. b . ..", " "]
    assert run(spark, texts, T.split_sentences) == [
        ["."], [], ["a."], [".", "a."], ["a.", ".", "b."], ["a.", "b.", "."], ["."],
    ]


def test_long_runs_stay_fast(spark):
    n = 400_000
    texts = [c * n for c in (" ", ".", ",", "\U0001f600", "#", "a", "\\u", "Tel", " ,", ". ", "中")]
    texts.append(" " * n + "x" + " " * n)
    assert run(spark, texts, T.strip_post) == [model.strip_post(t) for t in texts]


def test_basic_profile(spark):
    texts = [
        f"{S} www.a.com.cn. Tail #x , y",
        f"{S} www.a.com. 中",
        f"{S}\nline two",
        "short",
        "...",
    ]
    assert run(spark, texts, lambda c: T.clean_post(c, "basic")) == [
        f"{S}.Tail,y.",
        f"{S} www.a.com.中.",
        f"{S}\nline two.",
        "",
        "",
    ]


def test_emoji_only(spark):
    text = "22Merry  hello \U0001f477‍♂️ 111 中 \U0001f384 and"
    assert run(spark, [text], T.remove_emoji) == ["22Merry  hello ‍ 111 中  and"]


def test_projections(spark):
    posts = as_posts(spark.createDataFrame([(1, "t")], "id int, body string"), {"rowkey": "id", "post_content": "body"})
    assert [f.dataType.simpleString() for f in posts.schema] == ["string"] * 6
    row = posts.first()
    assert (row.rowkey, row.post_content, row.media) == ("1", "t", None)
    full = posts.withColumn("sub_industry_id", F.lit("1")).withColumn("parent_id", F.lit("2"))
    assert as_results(full.withColumn("x", F.lit(0))).columns[-2:] == ["sub_industry_id", "parent_id"]


def test_many_websites_equal_the_plain_pattern(spark):
    import random

    from tidemill import fixed_values as fv
    from tidemill.functions import text as X

    draw = random.Random(4)
    parts = ["www", "www.", ".com", ".com.cn", ".cn", "a", " ", "\n", ".", "w", "ww", "x.y", "\ue000", "\ue001", fv.WEBSITE_MARK,
             "#", "#t ", "https:", "Tel. 1", "Tel.2,", "Email Address: ", "Email Address:"]
    rows = [("".join(draw.choices(parts, k=draw.randint(1, 40))),) for _ in range(100_000)]
    frame = spark.createDataFrame(rows, "t string")
    before, X._MANY_WWW = X._MANY_WWW, 0
    try:
        found = frame.select(
            X.mark_websites("t").alias("a"), F.regexp_replace("t", fv.WEBSITE, fv.WEBSITE_MARK).alias("b"),
            X.remove_noise_and_websites("t").alias("c"), F.regexp_replace("t", X.NOISE_PATTERN_BASIC, "").alias("d"),
        )
        assert found.filter("not a <=> b or not c <=> d").count() == 0
        assert found.filter("a != t and c != t and a != c").count() > 1000
    finally:
        X._MANY_WWW = before


@pytest.mark.parametrize("first", ["", "\ue000", "\ue001 "])
@pytest.mark.parametrize("profile", ["full", "basic"])
def test_a_long_run_of_www_is_linear(spark, profile, first):
    import time

    from tidemill.functions import text as X

    step = X.mark_websites if profile == "full" else X.remove_noise_and_websites
    frame = spark.range(1).select(F.concat(F.lit(first), F.repeat(F.lit("www"), 350_000)).alias("t"))
    began = time.perf_counter()
    assert frame.select(step("t").alias("a")).filter(f"length(a) = {1_050_000 + len(first)}").count() == 1
    assert time.perf_counter() - began < 10
