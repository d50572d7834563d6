"""Named queries over a folder of parquet tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import sections as S
from pagewright.functions import text as X
from pagewright.functions import urls as U
from pagewright.functions import vectors as V
from pagewright.functions.binding import as_rows
from pagewright.operators import arithmetic, batching, content, enrich, landing, packing, paging, transcripts, words
from pagewright.operators.embedding import cosine_to_row, embed_texts
from pagewright.plans import documents as document_flow
from pagewright.plans import transcripts as transcript_flow
from pagewright.sinks import tables as sink
from pagewright.sources.tables import manifest as to_manifest
from pagewright.sources.tables import read_table, scan_binary_files, scan_whole_text, spread

PAGE_CHARS = 1000
PACK_BUDGET = 400
PAD_LENGTH = 16
EMBEDDING_DIMS = 64
GAP_MICROS = 6 * 3600 * 1_000_000
CHUNK_MICROS = 12 * 3600 * 1_000_000
LONG_BUDGET = 4000
SPREAD = 16
PAGE_TITLE = "<title>([^<]*)</title>"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for heavy per-row expressions."""
    return spread(read_table(spark, sf_dir, "documents"), _spread_tasks(spark), by=["doc_id"])


def _spread_tasks(spark: SparkSession) -> int | None:
    """Tasks for small files with few row groups, where the session asks for it."""
    wanted = spark.conf.get("spark.pagewright.spread", None)
    return int(wanted) if wanted else None


def _target(spark: SparkSession, sf_dir: str, table: str) -> tuple[str, str]:
    """Catalog name and shared path of a table written by a query of this session."""
    run = re.sub(r"\W", "_", f"{spark.sparkContext.applicationId}_{sf_dir.strip('/')}")
    return f"pagewright_{table}", f"{sink.shared_folder(spark)}/pagewright/{run}/{table}"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "pages"), _spread_tasks(spark), by=["page_id"])


def _page_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.page_sections(_pages(spark, sf_dir), ["page_id"])


def _expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_flow.expanded_content(_pages(spark, sf_dir), ["page_id"])


def _document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return paging.split_pages(documents, "doc_id", "text", PAGE_CHARS)


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_tokens(_documents(spark, sf_dir), keep_empty=False)


# Sources


@query
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", PAGE_TITLE, 1)
    return to_manifest(pages, title, F.col("url"), _page_date(), U.url_file_name(F.col("url")))


def _page_date() -> Column:
    """A date for each page, made from its id: the pages have none."""
    day = F.pmod("page_id", F.lit(365)).cast("int")
    return F.date_add(F.lit("2020-01-01").cast("date"), day).cast("string")


@query
def binary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files with their content, saved as a table, read back and compared line by line."""
    name, path = _target(spark, sf_dir, "landed_files")
    files = scan_binary_files(spark, _document_files(spark, sf_dir, "landed_text"), recursive=True)
    landed = sink.save_table(files, name, path)
    lines = F.explode(as_rows(F.split(F.col("content").cast("string"), "\n")))
    rows = landed.select(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang"), "length", lines.alias("line"))
    number = F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("bigint")
    counted = rows.groupBy("lang").agg(F.count("line").alias("n_lines"), F.sum(number).alias("line_sum"))
    sizes = landed.groupBy(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang")).agg(
        F.sum("length").alias("n_bytes"), F.count("*").alias("n_files")
    )
    # Each file ends in a line break, after which the split finds an empty line.
    empty = F.conv(F.substring(F.md5(F.lit("")), 1, 8), 16, 10).cast("bigint")
    return counted.join(sizes, "lang").select(
        "lang",
        "n_bytes",
        (F.col("n_lines") - F.col("n_files")).alias("n_lines"),
        (F.col("line_sum") - F.col("n_files") * empty).alias("line_sum"),
    )


def _document_files(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Folder with the documents as text files of bounded size, one sub-folder per language."""
    _, path = _target(spark, sf_dir, table)
    documents = read_table(spark, sf_dir, "documents").select("lang", "text")
    writer = documents.write.mode("overwrite").partitionBy("lang")
    writer.option("maxRecordsPerFile", 256).text(path)
    return path


@query
def speech_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole text files to words, counts, order, and a created table of them."""
    name, path = _target(spark, sf_dir, "speech_reference")
    speech = scan_whole_text(spark, _document_files(spark, sf_dir, "speech_text"))
    view = "pagewright_speech_reference"
    transcript_flow.speech_reference_counts(speech, "speaker").createOrReplaceTempView(view)
    return sink.create_table_as(spark, name, f"SELECT who, word, word_count FROM {view}", path)


@query
def whole_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text files of bounded size, each then read as one row."""
    path = _document_files(spark, sf_dir, "document_text")
    return scan_whole_text(spark, path).groupBy("lang").agg(
        F.sum(F.length("speech_text")).alias("n_chars")
    )


# Sinks and tables


@query
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of a database made for it, overwritten with another schema."""
    name, path = _target(spark, sf_dir, "documents")
    documents = read_table(spark, sf_dir, "documents")
    sink.create_database(spark, "pagewright_db")
    name = f"pagewright_db.{name}"
    sink.save_table(documents.select(F.col("doc_id").cast("string").alias("doc_id")), name, path)
    return sink.save_table(documents, name, path)


@query
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _target(spark, sf_dir, "pages_partitioned")
    pages = read_table(spark, sf_dir, "pages")
    keyed = sink.with_partition(pages, U.url_site(F.col("url")))
    table = sink.save_partitioned(keyed, name, path=path)
    return table.select("partition", "page_id", "url", F.length("html").alias("n_chars"))


@query
def ctas_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _target(spark, sf_dir, "conversations_copy")
    source = f"parquet.`{sf_dir.rstrip('/')}/conversations.parquet`"
    return sink.create_table_as(spark, name, f"SELECT conv_id, turn, role, text FROM {source}", path)


@query
def describe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a table that ``flow_document_tables`` writes; it is written here only if it is not there yet."""
    tables = _document_tables(spark, sf_dir)
    if not spark.catalog.tableExists(tables.name("expanded_content")):
        flow_document_tables(spark, sf_dir)
    return sink.describe_table(spark, tables.name("expanded_content"))


def _document_tables(spark: SparkSession, sf_dir: str) -> document_flow.DocumentTables:
    return document_flow.DocumentTables(*_target(spark, sf_dir, "document_flow"))


@query
def table_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, files and bytes of each partition; files and bytes are held against the folder's listing."""
    name, path = _target(spark, sf_dir, "events_partitioned")
    events = read_table(spark, sf_dir, "events")
    table = sink.save_partitioned(events, name, "event_type", path)
    listed = sink.listed_files(spark, path, "event_type").withColumnsRenamed({"num_files": "listed", "size_in_bytes": "listed_bytes"})
    # An outer join: a partition that only one side knows is a row with null or false.
    both = sink.table_detail(table, "event_type").join(listed, "event_type", "full")
    return both.select(
        "event_type",
        "num_rows",
        ((F.col("num_files") == F.col("listed")) & (F.col("listed") > 0)).alias("files_as_listed"),
        ((F.col("size_in_bytes") == F.col("listed_bytes")) & (F.col("listed_bytes") > 0)).alias("bytes_as_listed"),
    )


@query
def pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all sites that have a second page of something, read from those sites' partitions alone."""
    name, path = _target(spark, sf_dir, "pages_by_site")
    pages = read_table(spark, sf_dir, "pages").withColumn("site", U.url_site(F.col("url")))
    table = sink.save_partitioned(sink.with_partition(pages, F.col("site")), name, path=path)
    paged = pages.filter(F.contains(U.url_query_string(F.col("url")), F.lit("page=2")))
    wanted = sink.with_partition(paged.select("site"), F.col("site"))
    found = sink.read_partitions_of(table, wanted, "partition", ["site"])
    return found.select("partition", "site", "page_id", "url", F.length("html").alias("n_chars"))


# URLs and content


@query
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.url_parts(read_table(spark, sf_dir, "pages"), keys=["page_id"])


@query
def url_query_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landing.query_values(read_table(spark, sf_dir, "pages"), keys=["page_id"])
    return rows.withColumn("position", F.col("position").cast("bigint"))


@query
def url_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return read_table(spark, sf_dir, "pages").select(
        "page_id",
        U.url_file_name(url).alias("file_name"),
        U.url_file_name(url, keep_query=True).alias("file_name_with_query"),
        U.file_name_or_derived(F.lit(""), url).alias("derived_name"),
    )


@query
def partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return sink.with_partition(pages.select("page_id", "url"), U.url_site(F.col("url")))


@query
def resolve_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents looked up among the last turns of conversations; many have none."""
    url = lambda c: F.concat(F.lit("item/"), F.col(c).cast("string")).alias("url")
    rows = read_table(spark, sf_dir, "documents").select("doc_id", url("doc_id"))
    turns = read_table(spark, sf_dir, "conversations")
    landed = turns.select(url("conv_id"), F.col("text").alias("content"), "turn")
    return landing.resolve_content(rows, landed, newest_by="turn")


# Pages and sections


@query
def repartition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dealt out over a fixed number of tasks."""
    dealt = spread(read_table(spark, sf_dir, "documents"), SPREAD).withColumn("task", F.spark_partition_id())
    return dealt.agg(F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_chars"), F.count_distinct("task").alias("n_tasks"))


@query
def local_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the program, with a declared schema, joined with a table."""
    names = spark.createDataFrame(
        [("de", "German"), ("en", "English"), ("es", "Spanish"), ("fr", "French")], "lang string, language string"
    )
    documents = read_table(spark, sf_dir, "documents").join(F.broadcast(names), "lang", "left")
    return documents.groupBy("lang", "language").agg(F.count("*").alias("n_documents"))


@query
def layout_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = content.layout_blocks(_pages(spark, sf_dir), ["page_id"])
    return rows.withColumn("block_index", F.col("block_index").cast("bigint"))


@query
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = content.page_titles(_pages(spark, sf_dir), ["page_id"])
    return rows.withColumn("title_index_in_page", F.col("title_index_in_page").cast("bigint"))


@query
def assemble_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.sections(_page_content(spark, sf_dir), ["page_id"]).select(
        "page_id",
        F.col("section_index").cast("bigint").alias("section_index"),
        "title",
        "continuation",
        F.size("texts").cast("bigint").alias("n_texts"),
        F.array_join("texts", "\n").alias("joined"),
    )


@query
def sections_by_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of blocks that arrive out of order, several at one height, as from a layout detector."""
    blocks = content.layout_blocks(_pages(spark, sf_dir), ["page_id"])
    placed = blocks.withColumn("y", F.pmod(F.col("block_index") * 5 + F.length("text"), F.lit(7)))
    found = content.sections_from_blocks(placed.repartition("text"), ["page_id"])
    return content.sections(found, ["page_id"]).select(
        "page_id",
        F.col("section_index").cast("bigint").alias("section_index"),
        "title",
        "continuation",
        F.size("texts").cast("bigint").alias("n_texts"),
        F.array_join("texts", "\n").alias("joined"),
    )


def _positions_as_long(expanded: DataFrame) -> DataFrame:
    return expanded.withColumns(
        {c: F.col(c).cast("bigint") for c in ("section_index", "text_index")}
    )


@query
def expand_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions_as_long(_expanded(spark, sf_dir))


@query
def ordered_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.order_content(_positions_as_long(_expanded(spark, sf_dir)), ["page_id"])


@query
def sections_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = content.json_roundtrip(_page_content(spark, sf_dir), ["page_id"])
    return _positions_as_long(content.expand_sections(decoded, ["page_id"]))


@query
def section_text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = content.section_text_counts(_expanded(spark, sf_dir), ["page_id"])
    return counts.withColumn("section_index", F.col("section_index").cast("bigint"))


@query
def flow_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = document_flow.section_counts(_pages(spark, sf_dir), ["page_id"])
    return counts.withColumn("section_index", F.col("section_index").cast("bigint"))


# Documents and pages


@query
def split_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _document_pages(spark, sf_dir)
    return rows.withColumn("page", F.col("page").cast("bigint"))


@query
def page_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page_total(_document_pages(spark, sf_dir))


@query
def pages_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.pages_per_document(_document_pages(spark, sf_dir), "doc_id")


@query
def last_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = paging.last_page(_document_pages(spark, sf_dir), "doc_id")
    return rows.withColumn("last_page", F.col("last_page").cast("bigint"))


@query
def page_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.lookup(read_table(spark, sf_dir, "conversations"), conv_id=7, turn=1)


@query
def page_lookup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    found = paging.lookup_batch(read_table(spark, sf_dir, "documents"), labels, ["doc_id"])
    return found.select("doc_id", "lang", "source", "text")


@query
def path_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return paging.with_suffix(pages, "url", ".html")


@query
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return paging.sample_rows(conversations, ["conv_id", "turn"], 20)


# Words


@query
def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    tokens = words.word_tokens(documents, keys=["doc_id"], position="place")
    # Numbers are grouped without a sort, words are not: of them, one row per text comes here.
    numbers = tokens.groupBy("doc_id").agg(
        F.count("word").alias("n_tokens"),
        F.sum(F.length("word")).alias("n_chars"),
        F.count(F.when(F.col("word") == "", True)).alias("n_empty"),
        F.sum((F.col("place") + 1) * F.length("word")).alias("places"),
    )
    extremes = words.word_extremes(documents, keys=["doc_id"])
    both = numbers.unionByName(extremes, allowMissingColumns=True).groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_chars").alias("n_chars"),
        F.sum("n_empty").alias("n_empty"),
        F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word"),
        F.sum("places").alias("places"),
    )
    return both.filter("n_tokens is not null")


@query
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_counts(_words(spark, sf_dir), "documents")


@query
def word_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_counts_sql(_words(spark, sf_dir), "documents", "pagewright_words")


@query
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words(word_counts(spark, sf_dir), 100)


@query
def wrap_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return documents.select("doc_id", X.wrap_markers(F.col("text")).alias("bert_input_text"))


@query
def pad_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = X.pad_truncate(X.tokens(F.col("text"), first=PAD_LENGTH), PAD_LENGTH)
    documents = _documents(spark, sf_dir)
    return documents.select("doc_id", F.array_join(padded, " ").alias("tokens"))


@query
def pad_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents in batches of like length, each padded to its longest."""
    padded = batching.padded_batches(_documents(spark, sf_dir), ["doc_id"])
    return padded.select(
        "doc_id",
        "batch",
        F.col("n_tokens").cast("bigint").alias("n_tokens"),
        F.col("padded_length").cast("bigint").alias("padded_length"),
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
    )


# Transcripts


@query
def concat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read_table(spark, sf_dir, "conversations")
    return transcripts.concat_parts(parts, "conv_id", "turn", "text")


@query
def gap_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return transcripts.gap_segments(events, "user_id", "ts", GAP_MICROS)


@query
def pack_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transcripts.pack_lines(_documents(spark, sf_dir), "doc_id", "text", PACK_BUDGET)
    return rows.select(
        "doc_id",
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        "chunk",
        "n_chars",
        F.col("n_lines").cast("bigint").alias("n_lines"),
    )


@query
def pack_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns, which are rows, packed into chunks of their conversation."""
    turns = read_table(spark, sf_dir, "conversations")
    return packing.pack_texts(turns, "conv_id", "turn", "text", PACK_BUDGET)


@query
def pack_long_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that a role says as one long recording, whose segments are many blocks of rows."""
    place = (F.col("conv_id") * 1000 + F.col("turn")).alias("place")
    turns = read_table(spark, sf_dir, "conversations").select("role", place, "text")
    chunks = packing.pack_texts(turns, "role", "place", "text", LONG_BUDGET)
    return chunks.select("role", "chunk_index", F.md5("chunk").alias("chunk_md5"), "n_chars", "n_segments")


@query
def pack_gap_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of activity packed into chunks by their durations."""
    segments = sink.materialize(gap_segments(spark, sf_dir), "gap-segments")
    return packing.pack_timed(segments, "user_id", "segment_id", "start_micros", "end_micros", CHUNK_MICROS)


@query
def resume_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one answer store: a service that fails for some texts, then one that fails for fewer."""
    documents = _documents(spark, sf_dir)
    store = f"{sink.run_folder(spark)}/answer-store-{uuid.uuid4().hex}"
    enrich.resume_enrich(documents, "text", enrich.flaky_word_counter(3), ["doc_id"], store, slices=2)
    return enrich.resume_enrich(documents, "text", enrich.flaky_word_counter(6), ["doc_id"], store)


@query
def dedup_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return enrich.dedup_enrich(documents, "text", enrich.word_counter(), ["doc_id"])


@query
def flow_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read_table(spark, sf_dir, "conversations")
    return transcript_flow.transcript(parts, "conv_id", "turn", "text")


@query
def flow_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    recordings = _documents(spark, sf_dir)
    return transcript_flow.recording_transcript(recordings, "doc_id", "text", PACK_BUDGET)


@query
def flow_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that a role says as one recording, packed into chunks, recognized and put together again."""
    place = (F.col("conv_id") * 1000 + F.col("turn")).alias("place")
    turns = read_table(spark, sf_dir, "conversations").select("role", place, "text")
    return transcript_flow.segments_transcript(turns, "role", "place", "text", LONG_BUDGET)


@query
def flow_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    title = F.regexp_extract("html", PAGE_TITLE, 1)
    landed = pages.select("url", F.encode("html", "utf-8").alias("content"), "page_id")
    urls = transcript_flow.nlp_urls(pages, title, F.col("url"), _page_date())
    fetched = landing.with_content(urls, landed, newest_by="page_id")
    converted = transcript_flow.nlp_converted(transcript_flow.audio_raw(fetched))
    return converted.select(
        "title",
        "path",
        "file_name",
        "url",
        "site",
        "scheme",
        F.size("query").cast("bigint").alias("n_query_keys"),
        F.octet_length("content").cast("bigint").alias("n_bytes"),
        "speech_as_text",
    )


@query
def flow_transcript_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow as written tables: the rows of the last one."""
    pages = _pages(spark, sf_dir)
    name, path = _target(spark, sf_dir, "audio")
    landed = pages.select("url", F.encode("html", "utf-8").alias("content"), "page_id")
    urls = transcript_flow.nlp_urls(pages, F.regexp_extract("html", PAGE_TITLE, 1), F.col("url"), _page_date())
    tables = transcript_flow.write_transcript_tables(spark, urls, landed, PACK_BUDGET, name, path, "page_id")
    return tables["audio_partitioned"].select("partition", "url", "title", "date", "speech_as_text")


@query
def flow_document_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document flow as written tables: texts of each titled section."""
    tables = document_flow.write_document_tables(spark, _pages(spark, sf_dir), ["page_id"], _document_tables(spark, sf_dir))
    counts = tables["section_text_counts"]
    return counts.withColumn("section_index", F.col("section_index").cast("bigint"))


# Vectors


@query
def embed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    vectors = embed_texts(documents, output="vector")
    rows = vectors.select("doc_id", F.posexplode(as_rows(F.col("vector"))).alias("dim", "value"))
    return rows.select(
        "doc_id", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value")
    )


@query
def embed_by_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embed_text`` with texts of like length encoded together."""
    vectors = batching.embed_batches(_documents(spark, sf_dir), ["doc_id"])
    rows = vectors.select("doc_id", F.posexplode(as_rows(F.col("vector"))).alias("dim", "value"))
    return rows.select(
        "doc_id", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value")
    )


@query
def flow_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = document_flow.text_embeddings(_pages(spark, sf_dir), ["page_id"])
    value = F.posexplode(as_rows(F.col("text_bert_embeddings"))).alias("dim", "value")
    return vectors.select("page_id", "section_index", "continuation", "text_index", value).select(
        "page_id",
        F.col("section_index").cast("bigint").alias("section_index"),
        "continuation",
        F.col("text_index").cast("bigint").alias("text_index"),
        F.col("dim").cast("bigint").alias("dim"),
        F.round("value", 6).alias("value"),
    )


@query
def cosine_one_vs_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = cosine_to_row(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0)
    return scores.withColumn("similarity", F.round("similarity", 6))


@query
def cls_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    hidden = V.reshape(F.col("embedding"), 8, 8)
    rows = vectors.select("vec_id", F.posexplode(V.cls_pool(hidden)).alias("dim", "value"))
    return rows.select(
        "vec_id",
        F.col("dim").cast("bigint").alias("dim"),
        F.col("value").cast("double").alias("value"),
    )


@query
def vector_multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = V.multiply(F.col("l_quantity"), F.col("l_extendedprice"))
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(product, 2).alias("product")
    )


@query
def vector_multiply_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vector_multiply`` by a function over Arrow batches."""
    product = arithmetic.multiply_batches(F.col("l_quantity"), F.col("l_extendedprice"))
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", product.alias("product"))
    return rows.withColumn("product", F.round("product", 2))


@query
def price_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of every line's price from an Arrow batch function."""
    amounts = [F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount")]
    parts = F.explode(arithmetic.price_parts(*amounts)).alias("part")
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", parts)
    return rows.select("l_orderkey", "l_linenumber", "part.kind", F.round("part.value", 4).alias("value"))
