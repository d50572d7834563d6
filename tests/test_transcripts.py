import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from pagewright.functions import packing as P
from pagewright.operators import transcripts as R
from pagewright.plans import transcripts as flow


def test_concat_orders_and_skips_nulls(spark):
    rows = [("a", 2, "z"), ("a", 0, "x"), ("a", 1, None), ("b", 0, "only"), ("c", 0, None)]
    df = spark.createDataFrame(rows, "url string, chunk_index int, speech_as_text string")
    got = {r.url: r.converted_texts for r in R.concat_parts(df.repartition(4)).collect()}
    assert got == {"a": "x z", "b": "only", "c": ""}


def test_concat_gives_one_row_for_a_long_recording(spark):
    n = 36_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("url"),
        F.when(F.col("id") % 3 == 0, F.col("id") / 3).otherwise(F.col("id")).cast("int").alias("chunk_index"),
        F.col("id").cast("string").alias("speech_as_text"),
    )
    out = R.concat_parts(df.repartition(7))
    assert out.columns == ["url", "converted_texts"] and out.count() == 101
    hot = out.filter("url = 'hot'").collect()
    assert [r.converted_texts.split() for r in hot] == [[str(i) for i in range(0, n, 3)]]


def test_concat_takes_sparse_and_equal_indices(spark):
    rows = [("a", 9000, "z"), ("a", 0, "x"), ("a", 5000, "y"), ("a", 5000, None), ("b", 3, "q"), ("b", 3, "p")]
    df = spark.createDataFrame(rows, "url string, chunk_index int, speech_as_text string")
    got = {r.url: r.converted_texts for r in R.concat_parts(df.repartition(3)).collect()}
    assert got == {"a": "x y z", "b": "p q"}


def packs(spark, lists, budget):
    df = spark.createDataFrame(list(enumerate(lists)), "id int, lengths array<int>")
    rows = df.select("id", P.pack_starts(F.col("lengths"), budget).alias("s")).collect()
    return [r.s for r in sorted(rows, key=lambda r: r.id)]


def model_starts(lengths, budget):
    starts, total = [], 0
    for i, n in enumerate(lengths):
        if i == 0 or total + n >= budget:
            starts.append(i)
            total = n
        else:
            total += n
    return starts


def test_packing_examples(spark):
    assert packs(spark, [[4, 5, 1], [12, 3], [], [3], [0, 0, 10, 0]], 10) == [
        [0, 2], [0, 1], [], [0], [0, 2, 3]
    ]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(0, 15), max_size=30), min_size=1, max_size=30))
def test_packing_against_model(spark, lists):
    assert packs(spark, lists, 10) == [model_starts(x, 10) for x in lists]


def test_packing_across_fold_blocks(spark):
    rng = random.Random(5)
    lists = [
        [rng.randint(0, 9) for _ in range(n)]
        for n in (P.FOLD_BLOCK - 1, P.FOLD_BLOCK, P.FOLD_BLOCK + 1, 5 * P.FOLD_BLOCK + 7)
    ]
    assert packs(spark, lists, 10) == [model_starts(x, 10) for x in lists]
    assert packs(spark, lists, 100) == [model_starts(x, 100) for x in lists]


def test_pack_lines_keeps_every_line(spark):
    df = spark.createDataFrame([(1, "abcd\n\nefghi\nj\n"), (2, ""), (3, None)], "id int, text string")
    rows = [tuple(r) for r in R.pack_lines(df, "id", budget=10).collect()]
    assert rows == [(1, 0, "abcd\nefghi", 9, 2), (1, 1, "j", 1, 1)]


def model_segments(times, gap):
    out = []
    for t in sorted(times):
        if out and t - out[-1][-1] <= gap:
            out[-1].append(t)
        else:
            out.append([t])
    return [(i, len(s), s[0], s[-1]) for i, s in enumerate(out)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-300, 300), min_size=1, max_size=60))
def test_gap_segments_against_model(spark, offsets):
    origin = dt.datetime(1970, 1, 1)
    rows = [("k", origin + dt.timedelta(microseconds=o)) for o in offsets]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    for slots in (1, 3, 4096):
        got = R.gap_segments(df, "k", "ts", 10, slots).orderBy("segment_id").collect()
        assert [tuple(r)[1:] for r in got] == model_segments(offsets, 10)


def test_gap_segments_ignore_session_zone(spark):
    rows = [("k", dt.datetime(2024, 3, 31, 1, 59, 59)), ("k", dt.datetime(2024, 3, 31, 2, 30))]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        got = R.gap_segments(df, "k", "ts", 3_600_000_000).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [(r.n_events, r.end_micros - r.start_micros) for r in got] == [(2, 1_801_000_000)]


def test_gap_segments_keep_events_without_time(spark):
    rows = [("k", None), ("k", None), ("k", dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    got = R.gap_segments(df, "k", "ts", 10).orderBy("segment_id").collect()
    assert [(r.segment_id, r.n_events) for r in got] == [(0, 2), (1, 1)]


def test_gap_segments_hot_key(spark):
    """A third of all rows under one key reach the window as a few slots."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.timestamp_micros(F.col("id") * 7).alias("ts"),
    )
    out = R.gap_segments(df, "k", "ts", 1000)
    hot = out.filter("k = -1").collect()
    assert [(r.n_events, r.start_micros, r.end_micros) for r in hot] == [(n / 3, 0, (n - 3) * 7)]
    assert out.count() == 1 + n * 2 / 3
    plan = plan_of(out)
    assert plan.index("partial_count") > plan.index("Window")


def test_recording_flow(spark):
    df = spark.createDataFrame([("r", "aa \t b\ncc\n" + "d" * 12 + "\n e ")], "url string, content string")
    rows = flow.recording_transcript(df, "url", "content", 10).collect()
    assert [tuple(r) for r in rows] == [("r", "aa b cc " + "d" * 12 + " e")]


def test_three_tables(spark):
    source = spark.createDataFrame(
        [("t", "HTTP://h:1/a/f.mp3;p?x=1&x=2", b"<p>one<h1>T<p>two")],
        "name string, link string, content binary",
    )
    urls = flow.nlp_urls(source, F.col("name"), F.col("link"), F.lit("2020-01-01"))
    raw = flow.audio_raw(urls.crossJoin(source.select("content")))
    row = flow.nlp_converted(raw).head()
    assert (row.path, row.file_name, row.site, row.scheme) == ("/a/f.mp3", "f.mp3;p", "h:1", "http")
    assert row.query == {"x": ["1", "2"]} and row.speech_as_text == "one two"
    assert raw.columns == [
        "title", "date", "path", "file_name", "url", "site", "scheme", "query", "content"
    ]


def test_transcript_tables(spark, tmp_path):
    urls = flow.nlp_urls(
        spark.createDataFrame([("t1", "http://h/a?k=v"), ("t2", "http://g/b"), ("t3", "http://h/a?k=v")], "t string, u string"),
        F.col("t"),
        F.col("u"),
        F.lit("2020-01-01"),
    )
    content = b"<h1>T<p>first line\nsecond line<p>third"
    landed = spark.createDataFrame(
        [("http://h/a?k=v", content, 1)], "url string, content binary, modificationTime int"
    )
    out = flow.write_transcript_tables(spark, urls, landed, 20, "audio_test", str(tmp_path))
    # A URL listed twice keeps both manifest rows and is one recording.
    assert out["audio_raw"].count() == 3 and out["audio_converted"].count() == 1
    parts = [tuple(r) for r in out["audio_converted_parts"].orderBy("chunk_index").collect()]
    url = "http://h/a?k=v"
    assert parts == [(url, 0, "<h1>T<p>first line"), (url, 1, "second line<p>third")]
    whole = out["audio_converted"].head()
    assert whole.converted_texts == "<h1>T<p>first line second line<p>third"
    texts = {r.url: r.speech_as_text for r in spark.table("audio_test.audio_converted_v2").collect()}
    assert texts == {url: "first line\nsecond line third", "http://g/b": None}
    assert spark.table("audio_test.audio_partitioned").columns[-1] == "partition"
    spark.sql("DROP DATABASE audio_test CASCADE")


def test_speech_reference_counts(spark):
    df = spark.createDataFrame([("Hope and hope, change. Hope!",)], "speech_text string")
    rows = [tuple(r) for r in flow.speech_reference_counts(df, "speaker").collect()]
    assert rows == [("speaker", "Hope", 2), ("speaker", "change", 1), ("speaker", "hope", 1)]
