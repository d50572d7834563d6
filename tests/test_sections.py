from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import optimized_plan_of, plan_of
from pagewright.functions import sections as S
from pagewright.operators import content
from pagewright.plans import documents as flow
from pagewright.sources.tables import read_table

BLOCKS = "id int, blocks array<struct<kind: string, text: string>>"


def assembled(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), BLOCKS)
    rows = df.select("id", S.assemble_sections(F.col("blocks")).alias("s")).collect()
    return [
        [(s.title, list(s.texts), s.continuation) for s in r.s]
        for r in sorted(rows, key=lambda r: r.id)
    ]


def model(blocks):
    """Section rules in plain Python."""
    result = []
    for kind, text in blocks:
        text = text.strip()
        if not text or kind not in ("Title", "Text"):
            continue
        if kind == "Title":
            result.append((text, [], None))
        else:
            if not result:
                result.append((None, [], True))
            result[-1][1].append(text)
    return result


def test_hand_made_pages(spark):
    pages = [
        [("Text", "lead"), ("Title", "A"), ("Text", "a1"), ("Text", "a2")],
        [("Title", "A"), ("Title", "B"), ("Text", "b")],
        [("Title", " \t"), ("Text", "x")],
        [("Title", "A"), ("Text", "   "), ("Text", " y ")],
        [("Title", "A"), ("Title", "B")],
        [],
        [("List", "skip"), ("Table", "skip"), ("Text", "t")],
    ]
    assert assembled(spark, pages) == [
        [(None, ["lead"], True), ("A", ["a1", "a2"], None)],
        [("A", [], None), ("B", ["b"], None)],
        [(None, ["x"], True)],
        [("A", ["y"], None)],
        [("A", [], None), ("B", [], None)],
        [],
        [(None, ["t"], True)],
    ]


blocks_strategy = st.lists(
    st.tuples(st.sampled_from(["Title", "Text", "List"]), st.sampled_from(["", " ", "a", " b\n"])),
    max_size=12,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(blocks_strategy, min_size=1, max_size=40))
def test_against_model(spark, pages):
    assert assembled(spark, pages) == [model(p) for p in pages]


def test_order_blocks_is_stable(spark):
    df = spark.createDataFrame(
        [([("b", 2.0), ("a", 1.0), ("c", 2.0), ("d", 0.5)],)],
        "blocks array<struct<text: string, y: double>>",
    )
    ordered = df.select(S.order_blocks(F.col("blocks")).alias("b")).head().b
    assert [b.text for b in ordered] == ["d", "a", "b", "c"]


def test_sections_from_blocks_that_arrive_unsorted(spark):
    rows = [
        ("p", 0, 30.0, "Text", "below"), ("p", 1, 10.0, "Title", " Top "), ("p", 2, 20.0, "Text", "first"), ("p", 3, 20.0, "Text", "second"),
        ("p", 4, None, "Text", "no height"), ("p", 5, 40.0, "Title", " "), ("q", 9, 5.0, "Text", "alone"), ("r", 0, 1.0, "List", "none"),
    ]
    df = spark.createDataFrame(rows, "path string, at int, y double, kind string, text string").repartition(5)
    blocks = {r.path: [b.text for b in r.blocks] for r in content.blocks_by_page(df, ["path"], arrival="at").collect()}
    assert blocks["p"] == ["no height", " Top ", "first", "second", "below", " "]
    got = {r.path: [(s.title, s.texts, s.continuation) for s in r.image_content] for r in content.sections_from_blocks(df, ["path"], arrival="at").collect()}
    assert got == {"p": [(None, ["no height"], True), ("Top", ["first", "second", "below"], None)], "q": [(None, ["alone"], True)], "r": []}
    assert content.sections_from_blocks(df.limit(0), ["path"], arrival="at").count() == 0


def test_html_blocks(spark):
    html = 'x<li>i</li><div class="ad">ad</div><h1>T <b>u</h1><p>one<br>two<p> <footer>f&copy;'
    df = spark.createDataFrame([(html,), ("no blocks",), ("",), ("h1>x<p>y",), (None,)], "html string")
    rows = df.select(S.html_blocks(F.col("html")).alias("b")).collect()
    assert [tuple(b) for b in rows[0].b] == [
        ("List", "i"), ("Text", "ad"), ("Title", "T  u"), ("Text", "one two"), ("Text", ""),
        ("Text", "f&copy;"),
    ]
    assert rows[1].b == [] and rows[2].b == [] and rows[4].b is None
    assert [tuple(b) for b in rows[3].b] == [("Text", "y")]


def test_html_blocks_with_other_tags(spark):
    df = spark.createDataFrame([("a<h2>T<p>x<h.>y",)], "html string")
    tags = {"<h2>": "Title", "<h.>": "Text"}
    blocks = df.select(S.html_blocks(F.col("html"), tags).alias("b")).head().b
    assert [tuple(b) for b in blocks] == [("Title", "T x"), ("Text", "y")]


def test_page_titles_skip_blank(spark):
    df = spark.createDataFrame([(1, "<h1> A</h1><h1> </h1><p>x<h1>B")], "page_id int, html string")
    rows = content.page_titles(df, ["page_id"]).collect()
    assert [(r.title_index_in_page, r.title) for r in rows] == [(0, "A"), (1, "B")]


def page_content(spark):
    return spark.createDataFrame(
        [
            ("p", 0, [("A", ["x", "y"], None), ("B", [], None)]),
            ("p", 1, [(None, ["z", None], True)]),
            ("p", 2, []),
            ("p", 3, None),
        ],
        "path string, page int, "
        "image_content array<struct<title: string, texts: array<string>, continuation: boolean>>",
    )


def test_expand_drops_or_keeps_empty(spark):
    keys = ["path", "page"]
    rows = content.expand_sections(page_content(spark), keys).collect()
    assert [tuple(r) for r in rows] == [
        ("p", 0, 0, "A", None, 0, "x"),
        ("p", 0, 0, "A", None, 1, "y"),
        ("p", 1, 0, None, True, 0, "z"),
        ("p", 1, 0, None, True, 1, None),
    ]
    assert content.expand_sections(page_content(spark), keys, keep_empty=True).count() == 7


def test_both_counts_agree(spark):
    keys = ["path", "page"]
    expanded = content.expand_sections(page_content(spark), keys)
    expected = [("p", 0, 0, "A", 2)]
    assert [tuple(r) for r in content.section_text_counts(expanded, keys).collect()] == expected
    assert [tuple(r) for r in content.count_section_texts(page_content(spark), keys).collect()] == expected


def test_json_decoding_is_lenient(spark):
    texts = ['[{"texts":["a"],"continuation":true}]', '[{"title":"T","texts":[]}]', "not json"]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    rows = df.select(S.sections_from_json(F.col("j")).alias("s")).collect()
    assert [tuple(s) for s in rows[0].s] == [(None, ["a"], True)]
    assert [tuple(s) for s in rows[1].s] == [("T", [], None)]
    assert rows[2].s is None


def test_plans(spark, tiny):
    pages = read_table(spark, tiny, "pages")
    expanded = plan_of(flow.expanded_content(pages, ["page_id"]))
    assert "Exchange" not in expanded and "Python" not in expanded
    counts = flow.section_counts(pages, ["page_id"])
    # One exchange for the grouping, one for the order; the page source is cut only once.
    assert plan_of(counts).count("Exchange ") == 2
    assert optimized_plan_of(counts).count("split(html") == 1
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan_of(counts)


def test_document_tables(spark, tiny, tmp_path):
    pages = read_table(spark, tiny, "pages")
    names = flow.DocumentTables("docs_test", str(tmp_path))
    written = flow.write_document_tables(spark, pages, ["page_id"], names)
    assert spark.table("docs_test.expanded_content").count() == written["expanded_content"].count()
    lazy = flow.section_counts(pages, ["page_id"]).collect()
    assert written["section_text_counts"].orderBy("page_id", "section_index").collect() == lazy
    spark.sql("DROP DATABASE docs_test CASCADE")
