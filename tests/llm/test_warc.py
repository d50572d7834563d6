from pyspark.sql import functions as F
import gzip
import json
import os
import random

import pytest

from pagewright.llm import warc


def brute(pages, least=0):
    groups = {}
    for i, _, html in pages:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        ids = [x for x in groups[raw] if x is not None]
        first = min(ids) if ids and len(groups[raw]) > 1 and len(raw) >= least else None
        revisit = first is not None and i != first
        out.append((i, len(raw), warc.payload_digest(raw), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def sample():
    r = random.Random(4)
    bodies = ["", None, "a\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\n", "é" * 5000, "\r\n\r\n", "x" * 3_000_000, "<p>\n</p>\x00"]
    pages = [(k, r.choice(["http://a/b", None, "http://x\r\ny z"]), r.choice(bodies + [f"own {k}"])) for k in range(120)]
    return pages + [(None, "u", "é" * 5000), (None, "u", "only null"), (5, "u", "twice"), (5, "u", "twice"), (9, "u", "twice")]


SCHEMA = "page_id long, url string, html string"


def test_round_trip_equals_brute_force(spark):
    pages = sample()
    df = spark.createDataFrame(pages, SCHEMA).repartition(5)
    assert sorted(map(tuple, warc.archive_report(df).collect()), key=str) == brute(pages)


def test_every_record_is_a_member_at_its_offset(spark):
    pages = sample()
    folder = warc.archive_pages(spark.createDataFrame(pages, SCHEMA).repartition(3), least_bytes=10)
    local = folder.removeprefix("file://")
    seen = []
    for name in sorted(x for x in os.listdir(local) if x.endswith(".warc.gz")):
        data = open(f"{local}/{name}", "rb").read()
        entries = [json.loads(x) for x in open(f"{local}/{name.removesuffix('.warc.gz')}.index.json")]
        assert [e["offset"] for e in entries] == [sum(e["length"] for e in entries[:k]) for k in range(len(entries))]
        assert sum(e["length"] for e in entries) == len(data)
        whole = b"".join(gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]) for e in entries)
        assert whole == gzip.decompress(data)
        seen += [e["page_id"] for e in entries]
    assert sorted(map(str, seen)) == sorted(str(p[0]) for p in pages)
    assert not [x for x in os.listdir(local) if x.endswith(".tmp")]
    rows = warc.read_records(spark, folder).collect()
    number = lambda x: x and int(x)
    got = [(number(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in rows]
    assert sorted(got, key=str) == brute(pages, 10)
    payloads = {bytes(r.payload) for r in rows if r.record_type == "response"}
    assert payloads == {(h or "").encode() for _, _, h in pages}


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "u", "t", 5, "x")], SCHEMA + ", payload_bytes long, record_type string")
    assert warc.archive_report(df).collect()[0][:2] == (1, 1)
    assert warc.archive_report(df.limit(0)).count() == 0


def test_streams_of_any_chunking_and_broken_ones():
    records = [warc.record_of(k, "u", b"p" * k, None if k % 2 else 7) for k in range(9)]
    stream = b"".join(r + warc.END for r in records)
    for size in (1, 7, 10_000):
        assert list(warc.records_of(iter([stream[i : i + size] for i in range(0, len(stream), size)]))) == records
    two = gzip.compress(stream) + gzip.compress(stream)
    assert b"".join(warc.inflated(two)) == stream * 2
    with pytest.raises(ValueError):
        list(warc.records_of(iter([stream[:-3]])))
    with pytest.raises(ValueError):
        list(warc.inflated(gzip.compress(stream)[:-20]))


def test_equal_payloads_are_spread_over_files(spark, tmp_path):
    """Adaptive execution off: the salts alone deal a payload that half of the pages share out over tasks."""
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), F.when(F.col("id") % 2 == 0, "hot" * 50).otherwise(F.concat(F.lit("p"), "id")).alias("html"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        warc.write_monolithic(pages.repartition(4), f"{tmp_path}/files")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    revisits = spark.read.text(f"{tmp_path}/files").where("value like 'WARC-Type: revisit%'").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in revisits) == 1499 and len(revisits) > 1
