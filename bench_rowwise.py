"""Times the row-at-a-time Python formulation of a few queries, for comparison.

Same tables, same session and the same results as the named queries, but written the
direct way: Python functions per row, collected rows, a sort ahead of the grouping. Prints
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pagewright.functions.sections import SECTION_SCHEMA  # noqa: E402
from pagewright.functions.text import STOP_WORDS  # noqa: E402
from pagewright.session import build_session  # noqa: E402


def sections(spark, d):
    import re
    from itertools import accumulate, groupby

    block = re.compile('<(h1|p|footer|div class="ad"|li)>(.*?)(?=<(?:h1|p|footer|div class="ad"|li)>|$)', re.S)

    def extract(html):
        found = [(name, re.sub("<[^>]*>", " ", body).strip()) for name, body in block.findall(html)]
        found = [(name, text) for name, text in found if text and name != "li"]
        numbers = accumulate(name == "h1" for name, _ in found)
        numbered = groupby(zip(numbers, found, strict=True), key=lambda item: item[0])
        grouped = {n: [pair for _, pair in items] for n, items in numbered}
        return [
            {
                "title": pairs[0][1] if n else None,
                "texts": [text for name, text in pairs if name != "h1"],
                "continuation": None if n else True,
            }
            for n, pairs in grouped.items()
        ]

    pages = spark.read.parquet(f"{d}/pages.parquet")
    content = pages.select("page_id", F.udf(extract, SECTION_SCHEMA)("html").alias("c"))
    rows = content.select("page_id", F.posexplode("c").alias("section_index", "s"))
    expanded = rows.select("page_id", "section_index", "s.title", F.explode("s.texts").alias("text"))
    counts = expanded.filter("title IS NOT NULL").groupBy("page_id", "section_index", "title")
    return counts.agg(F.count("text").alias("n_texts")).orderBy("page_id", "section_index")


def word_counts(spark, d):
    stop = set(STOP_WORDS)
    is_stop = F.udf(lambda w: w is None or w in stop, "boolean")
    words = spark.read.parquet(f"{d}/documents.parquet").select(
        F.explode(F.split("text", r"[^a-zA-Z\d:]")).alias("word")
    )
    kept = words.filter(F.col("word").rlike("[a-zA-Z]+") & ~is_stop(F.lower("word")))
    return kept.groupBy("word").agg(F.count("word").alias("word_count"))


def url_parts(spark, d):
    from urllib.parse import urlparse

    def split(url):
        parsed = urlparse(url)
        return parsed.scheme, parsed.netloc, parsed.path, parsed.query

    parts = F.udf(split, "scheme string, site string, path string, query_string string")
    pages = spark.read.parquet(f"{d}/pages.parquet")
    return pages.select("page_id", "url", parts("url").alias("p")).select("page_id", "url", "p.*")


def split_pages(spark, d):
    cut = F.udf(lambda t: [t[i : i + 1000] for i in range(0, len(t), 1000)], "array<string>")
    documents = spark.read.parquet(f"{d}/documents.parquet")
    return documents.select("doc_id", F.posexplode(cut("text")).alias("page", "page_text"))


def pack_segments(spark, d):
    def pack(text):
        chunks, size = [], 0
        for line in filter(None, text.split("\n")):
            if not chunks or size + len(line) >= 400:
                chunks.append(line)
                size = len(line)
            else:
                chunks[-1] += "\n" + line
                size += len(line)
        return chunks

    documents = spark.read.parquet(f"{d}/documents.parquet")
    return documents.select(
        "doc_id", F.posexplode(F.udf(pack, "array<string>")("text")).alias("chunk_index", "chunk")
    )


def wrap_markers(spark, d):
    wrap = F.udf(lambda t: "[CLS] " + t + "[SEP]")
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", wrap("text").alias("t"))


def cosine_one_vs_rest(spark, d):
    import numpy as np

    rows = spark.read.parquet(f"{d}/embeddings.parquet").select("embedding").collect()
    vectors = np.array([r.embedding for r in rows])
    lengths = np.linalg.norm(vectors, axis=1)
    scores = vectors[1:] @ vectors[0] / (lengths[1:] * lengths[0])
    return spark.createDataFrame([(float(s),) for s in scores], "similarity double")


QUERIES = {
    "flow_sections": sections,
    "word_counts": word_counts,
    "url_parts": url_parts,
    "split_pages": split_pages,
    "pack_segments": pack_segments,
    "wrap_markers": wrap_markers,
    "cosine_one_vs_rest": cosine_one_vs_rest,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("bench-rowwise", f"local[{cpus}]", cores=cpus, extra=extra)
    timings = {}
    for name, query in QUERIES.items():
        runs = []
        for _ in range(4):
            started = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "row-wise Python", "unit": "sec", "queries": timings}))
    spark.stop()


if __name__ == "__main__":
    main()
