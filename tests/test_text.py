import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from pagewright.functions import text as X
from pagewright.operators import paging, words
from pagewright.queries import QUERIES
from pagewright.sources.tables import read_table


def test_strip_removes_what_python_strips(spark):
    every = "".join(chr(c) for c in range(0x3100) if not chr(c).strip())
    df = spark.createDataFrame([(every + "a b" + every,), (every,), ("",), (None,)], "t string")
    assert [r.s for r in df.select(X.strip(F.col("t")).alias("s")).collect()] == ["a b", "", "", None]


def test_markers(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "t string")
    got = [r.m for r in df.select(X.wrap_markers(F.col("t")).alias("m")).collect()]
    assert got == ["[CLS] x[SEP]", "[CLS] [SEP]", None]


def test_stop_words(spark):
    df = spark.createDataFrame([("the",), ("dave",), (None,), ("THE",), ("don",)], "w string")
    assert [r.s for r in df.select(X.is_stop_word(F.col("w")).alias("s")).collect()] == [
        True, False, True, False, True
    ]
    X.register_stop_word_function(spark)
    df.createOrReplaceTempView("some_words")
    in_sql = spark.sql("SELECT is_stop_word(w) AS s FROM some_words")
    assert [r.s for r in in_sql.collect()] == [True, False, True, False, True]
    assert "Python" not in plan_of(in_sql)


def test_words_of_hand_made_text(spark):
    df = spark.createDataFrame([("don't stop: 10:30, café THE the",), ("",), (None,)], "text string")
    tokens = [r.word for r in words.word_tokens(df).collect()]
    assert tokens == ["don", "t", "stop:", "10:30", "", "caf", "", "THE", "the", ""]
    counts = words.word_counts(words.word_tokens(df), "w").collect()
    assert sorted((r.word, r.word_count) for r in counts) == [("caf", 1), ("stop:", 1)]


def test_word_extremes(spark):
    df = spark.createDataFrame([(1, "b a,C"), (1, "b"), (2, "é"), (3, None), (None, "z")], "id int, text string")
    rows = words.word_extremes(df, keys=["id"]).collect()
    assert [tuple(r) for r in rows] == [(1, "C", "b"), (1, "b", "b"), (2, "", ""), (3, None, None), (None, "z", "z")]
    bare = words.word_extremes(df, keep_empty=False).collect()
    assert [tuple(r) for r in bare] == [("C", "b"), ("b", "b"), (None, None), (None, None), ("z", "z")]


def test_word_tokens_query_sorts_no_word_rows(spark, tmp_path):
    """Ids that come twice or are null form one group; null texts none; words are not sorted to be grouped."""
    texts = [(1, "b a, C"), (1, "Zz b"), (2, ""), (3, None), (None, "q"), (None, "r p"), (4, "é")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["word_tokens"](spark, str(tmp_path))
    expected = {}
    for i, text in texts:
        if text is not None:
            expected.setdefault(i, []).append(re.split("[^a-zA-Z0-9:]", text))
    for r in found.collect():
        of_id = expected.pop(r.doc_id)
        flat = [w for split in of_id for w in split]
        places = sum(k * len(w) for split in of_id for k, w in enumerate(split, 1))
        assert tuple(r)[1:] == (len(flat), sum(map(len, flat)), flat.count(""), min(flat), max(flat), places)
    assert not expected
    above_words = plan_of(found).split("Generate")[0].rsplit("Exchange", 1)[1]
    assert "HashAggregate" in above_words and "Sort" not in above_words


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=30), min_size=1, max_size=40))
def test_word_split_against_python(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = sorted(df.select("id", X.words(F.col("t")).alias("w")).collect(), key=lambda r: r.id)
    for text, row in zip(texts, rows):
        assert row.w == re.split(r"[^a-zA-Z0-9:]", text)


def test_word_counts_and_sql_agree(spark, tiny):
    tokens = words.word_tokens(read_table(spark, tiny, "documents"))
    a = words.word_counts(tokens, "x")
    b = words.word_counts_sql(tokens, "x", "agreeing")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    # Words are counted before they are shuffled.
    assert plan_of(a).index("partial_count") > plan_of(a).index("Exchange hashpartitioning")


def test_top_words_plan(spark, tiny):
    counts = words.word_counts(words.word_tokens(read_table(spark, tiny, "documents")), "x")
    assert "TakeOrderedAndProject" in plan_of(words.top_words(counts, 10))


def test_pad_truncate(spark):
    df = spark.createDataFrame([("a b c d",), ("A",), ("",)], "t string")
    rows = df.select(X.pad_truncate(X.tokens(F.col("t")), 3).alias("p")).collect()
    assert [r.p for r in rows] == [["a", "b", "c"], ["a"] + ["[PAD]"] * 2, ["[PAD]"] * 3]


def test_first_tokens_equal_the_full_split(spark):
    texts = ["", "  ", " a b", "a b c d e", "a, b", "..a..b..c..", "a b c ", "é a é b é c d"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in range(5):
        rows = df.select(
            X.tokens(F.col("t"), first=n).alias("few"), X.tokens(F.col("t")).alias("all")
        ).collect()
        assert [r.few for r in rows] == [r["all"][:n] for r in rows]


def test_words_without_empty(spark, tiny):
    df = read_table(spark, tiny, "documents")
    full = words.word_tokens(df, keys=["doc_id"]).filter("word <> ''")
    short = words.word_tokens(df, keys=["doc_id"], keep_empty=False)
    assert full.exceptAll(short).isEmpty() and short.exceptAll(full).isEmpty()


page_text = st.text(alphabet="aé\n漢😀 ", max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(page_text, min_size=1, max_size=30))
def test_pages_hold_the_whole_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "path int, text string")
    pages = {}
    for r in paging.split_pages(df, page_chars=7).collect():
        pages.setdefault(r.path, []).append((r.page, r.page_text))
    for i, text in enumerate(texts):
        expected = [text[s : s + 7] for s in range(0, len(text), 7)] or [""]
        assert sorted(pages[i]) == list(enumerate(expected))


def test_very_long_page_of_mixed_width(spark):
    text = "a😀" * 60_000
    df = spark.createDataFrame([("p", text)], "path string, text string")
    rows = paging.split_pages(df, page_chars=100_000).orderBy("page").collect()
    assert [len(r.page_text) for r in rows] == [100_000, 20_000]


def test_page_counts(spark):
    pages = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "path string, page int")
    assert paging.page_total(pages).head().n_pages == 3
    assert dict(map(tuple, paging.pages_per_document(pages).collect())) == {"a": 2, "b": 1}
    assert dict(map(tuple, paging.last_page(pages).collect())) == {"a": 1, "b": 0}


def test_lookup_reaches_the_scan(spark, tiny):
    found = paging.lookup(read_table(spark, tiny, "conversations"), conv_id=7, turn=1)
    assert "EqualTo(conv_id,7), EqualTo(turn,1)" in plan_of(found)
    suffix = paging.with_suffix(read_table(spark, tiny, "pages"), "url", ".html")
    assert "StringEndsWith(url,.html)" in plan_of(suffix)


def test_lookup_batch(spark):
    pages = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "path string, page int")
    keys = spark.createDataFrame([("a", 1), ("a", 1), ("c", 0)], "path string, page int")
    found = paging.lookup_batch(pages, keys, ["path", "page"]).collect()
    assert [tuple(r) for r in found] == [("a", 1)]
