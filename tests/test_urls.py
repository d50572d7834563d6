import hashlib
import re
from urllib.parse import parse_qs, urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.functions import urls as U
from pagewright.operators import landing

URLS = [
    "HTTP://u@ex.com:80/a/b;p?q=1&q=2&e=&r=a+b%20c#f",
    "http://ex.com",
    "https://x.com/",
    "nourl",
    "http://a/b?x=c/d",
    "http://a/b?x=%zz&y=%41%zz",
    "http://a/b;c/d;e;f?k&x=1&=v",
    "mailto:me;x@y",
    "1a:b",
    "//host/path",
    "",
]


def parts(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "id int, url string")
    u = F.col("url")
    split = df.select(
        "id",
        U.url_scheme(u).alias("scheme"),
        U.url_site(u).alias("site"),
        U.url_path(u).alias("path"),
        U.query_map(U.url_query_string(u)).alias("query"),
    )
    return sorted(split.collect(), key=lambda r: r.id)


def assert_like_python(spark, urls):
    for url, row in zip(urls, parts(spark, urls)):
        parsed = urlparse(url)
        assert (row.scheme, row.site, row.path) == (parsed.scheme, parsed.netloc, parsed.path), url
        assert row.query == parse_qs(parsed.query), url


def test_hand_made_urls(spark):
    assert_like_python(spark, URLS)


piece = st.text(alphabet="ab1=&+%2;/é", max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(piece, min_size=1, max_size=40))
def test_query_strings(spark, pieces):
    # Bytes that are no UTF-8 are replaced in ways that differ, so they stay out.
    whole = [p for p in pieces if "�" not in str(parse_qs(p))]
    assert_like_python(spark, ["http://h/p?" + p for p in whole] or ["http://h/p"])


def test_file_names(spark):
    urls = ["http://h/a/b.mp3?abc=1", "https://x.com/", "http://a/b?x=c/d", "nourl", "http://a/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = df.select(
        U.url_file_name(F.col("url")).alias("f"),
        U.url_file_name(F.col("url"), keep_query=True).alias("q"),
        U.file_name_or_derived(F.lit("given"), F.col("url")).alias("g"),
        U.file_name_or_derived(F.lit(""), F.col("url")).alias("e"),
    ).collect()
    assert [r.f for r in rows] == ["b.mp3", "x.com", "d", None, "a"]
    assert [r.q for r in rows] == ["b.mp3?abc=1", "x.com", "d", None, "a"]
    assert all(r.g == "given" for r in rows) and [r.e for r in rows] == [r.f for r in rows]


def test_partition_key_is_even(spark):
    counts = (
        spark.range(100_000)
        .select(U.partition_key(F.concat(F.lit("s"), F.col("id"))).alias("k"))
        .groupBy("k")
        .count()
        .collect()
    )
    assert len(counts) == 256 and max(r["count"] for r in counts) < 600


@pytest.fixture
def landed(spark):
    return spark.createDataFrame(
        [("u1", b"old", 1), ("u1", b"newest", 2), ("u2", b"xy", 1), ("u9", b"unused", 1)],
        "url string, content binary, modificationTime int",
    )


def test_resolve_content(spark, landed):
    manifest = spark.createDataFrame(
        [(1, "u1"), (2, "u2"), (3, "u3"), (4, None)], "id int, url string"
    )
    rows = landing.resolve_content(manifest, landed).orderBy("id").collect()
    assert [(r.id, r.found, r.n_bytes) for r in rows] == [
        (1, True, 6), (2, True, 2), (3, False, None), (4, False, None)
    ]
    full = landing.with_content(manifest, landed).orderBy("id").collect()
    assert [r.content for r in full] == [bytearray(b"newest"), bytearray(b"xy"), None, None]


def test_newest_copy_with_ties_and_without_versions(spark):
    """One row per manifest row, the same on every run, and bytes wherever something landed."""
    rows = [("tie", b"aa", 5), ("tie", b"bbb", 5), ("tie", b"bbb", 5), ("none", b"cccc", None), ("mixed", b"old", 1)]
    rows += [("mixed", b"unknown", None), ("null", None, 3)]
    schema = "url string, content binary, modificationTime int"
    manifest = spark.createDataFrame([(u,) for u in ("tie", "none", "mixed", "null", "gone")], "url string")
    seen = set()
    for parts in (1, 3, 7):
        landed = spark.createDataFrame(rows, schema).repartition(parts)
        found = {r.url: (r.found, r.n_bytes) for r in landing.resolve_content(manifest, landed).collect()}
        full = landing.with_content(manifest, landed).collect()
        assert len(full) == 5 and found["none"] == (True, 4) and found["mixed"] == (True, 3)
        assert found["null"] == (True, None) and found["gone"] == (False, None)
        contents = {r.url: None if r.content is None else bytes(r.content) for r in full}
        assert {u: c and len(c) for u, c in contents.items()} == {u: n for u, (_, n) in found.items()}
        seen.add(contents["tie"])
    assert len(seen) == 1


def test_resolve_content_with_a_hot_url(spark, landed):
    n = 30_000
    manifest = spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, "u1")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("m"), F.col("id")))
        .alias("url"),
    )
    for resolved in (
        landing.resolve_content(manifest, landed, spread_by=["id"]),
        landing.with_content(manifest, landed, spread_by=["id"]),
    ):
        assert resolved.count() == n
    found = landing.resolve_content(manifest, landed, spread_by=["id"]).groupBy("found").count()
    assert {r.found: r["count"] for r in found.collect()} == {True: 10_000, False: 20_000}


def test_content_goes_through_one_exchange(spark, tmp_path):
    """Also that of a URL which fills the manifest, and with copies in many files."""
    manifest = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("url"))
    manifest.write.parquet(f"{tmp_path}/manifest")
    landed = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") % 4 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 1500)).alias("url"),
        F.concat(F.lit("body "), "id").cast("binary").alias("content"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("version"),
    )
    landed.write.parquet(f"{tmp_path}/landed")
    manifest, landed = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("manifest", "landed"))
    out = landing.with_content(manifest, landed, newest_by="version")
    rows = {r.id: r.content for r in out.collect()}
    told = {}
    for r in landed.collect():
        key = (r.version is not None, r.version or 0, hashlib.sha256(bytes(r.content)).hexdigest(), bytes(r.content))
        told[r.url] = max(told.get(r.url, key), key)
    assert rows == {r.id: told[r.url][3] if r.url in told else None for r in manifest.collect()}
    plan = out._jdf.queryExecution().explainString(out.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    # The plan is told twice, as it began and as it ran; what chooses the newest is passed on in the place of content.
    assert len({x for x in exchanges if "content" in x or "ExtremumOrdering" in x}) == 1
