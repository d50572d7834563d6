"""The transcript flow: manifest, raw content, parts, text per part, text per recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import sections as S
from pagewright.functions import text as X
from pagewright.functions import urls as U
from pagewright.operators.content import joined_texts
from pagewright.operators.landing import attach_content, newest_content
from pagewright.operators.packing import pack_texts
from pagewright.operators.transcripts import concat_parts, pack_lines
from pagewright.operators.words import top_words, word_counts, word_tokens
from pagewright.sinks import tables as sink
from pagewright.sources.tables import manifest


def converted_parts(
    parts: DataFrame, key: str, index: str, text: str, language: str = "en-US"
) -> DataFrame:
    """Text of every part, from the part and one literal argument."""
    spoken = X.speech_text(F.col(text), F.lit(language))
    return parts.select(key, index, spoken.alias("speech_as_text"))


def transcript(
    parts: DataFrame, key: str, index: str, text: str, language: str = "en-US"
) -> DataFrame:
    """Parts to (key, converted_texts)."""
    return concat_parts(converted_parts(parts, key, index, text, language), key, index)


def recording_transcript(
    recordings: DataFrame, key: str, content: str, budget: int, language: str = "en-US"
) -> DataFrame:
    """Whole recordings to chunks under a budget, text per chunk, text per recording."""
    chunks = pack_lines(recordings, key, content, budget)
    return transcript(chunks, key, "chunk_index", "chunk", language)


def segments_transcript(
    segments: DataFrame, key: str, position: str, content: str, budget: int, language: str = "en-US"
) -> DataFrame:
    """``recording_transcript`` of recordings whose segments are rows, however many a recording has."""
    chunks = pack_texts(segments, key, position, content, budget)
    return transcript(chunks, key, "chunk_index", "chunk", language)


# The same flow as three named tables. Each function takes the table it reads.


def nlp_urls(source: DataFrame, title: Column, url: Column, date: Column) -> DataFrame:
    """Manifest rows (title, url, date, file_name)."""
    return manifest(source, title, url, date)


def audio_raw(urls_with_content: DataFrame, content: str = "content") -> DataFrame:
    """Manifest rows with URL parts and content.

    Takes manifest rows that carry their content; ``landing.with_content`` makes them
    from a landed table.
    """
    u = F.col("url")
    return urls_with_content.select(
        "title",
        "date",
        U.url_path(u).alias("path"),
        U.file_name_or_derived(F.col("file_name"), u).alias("file_name"),
        "url",
        U.url_site(u).alias("site"),
        U.url_scheme(u).alias("scheme"),
        U.query_map(U.url_query_string(u)).alias("query"),
        F.col(content).alias("content"),
    )


def nlp_converted(raw: DataFrame) -> DataFrame:
    """Raw rows plus ``speech_as_text``: all texts of the content joined by a space."""
    html = F.col("content").cast("string")
    spoken = joined_texts(S.assemble_sections(S.html_blocks(html), stripped=True))
    return raw.withColumn("speech_as_text", spoken)


def speech_reference_counts(speech: DataFrame, who: str, text: str = "speech_text") -> DataFrame:
    """Word counts of a reference transcript, most frequent first."""
    return top_words(word_counts(word_tokens(speech, text), who))


def write_transcript_tables(
    spark: SparkSession,
    urls: DataFrame,
    landed: DataFrame,
    budget: int,
    database: str = "audio",
    location: str | None = None,
    newest_by: str = "modificationTime",
) -> dict[str, DataFrame]:
    """Run the flow table by table.

    Writes audio_raw, audio_converted_parts, audio_converted, audio_converted_v2 and
    audio_partitioned. ``urls`` has the manifest's columns, ``landed`` the content of each
    URL. Each stage reads the table written before it. A URL that the manifest lists more
    than once is one recording: its parts and texts are made once, from the newest copy of its
    content, which is chosen once for all stages.
    """
    sink.create_database(spark, database)

    def path(table: str) -> str | None:
        return f"{location.rstrip('/')}/{table}" if location else None

    def save(df: DataFrame, table: str) -> DataFrame:
        return sink.save_table(df, f"{database}.{table}", path(table))

    # The semi-join deals contents out by URL, and the choice of the newest needs no other exchange.
    listed = landed.join(urls.select("url").distinct(), "url", "left_semi")
    recordings = sink.materialize(newest_content(listed, "url", "content", newest_by), "recordings")
    raw = save(audio_raw(attach_content(urls, recordings)), "audio_raw")
    spoken = recordings.select("url", F.col("content").cast("string").alias("content"))
    chunks = pack_lines(spoken, "url", "content", budget)
    parts = save(converted_parts(chunks, "url", "chunk_index", "chunk"), "audio_converted_parts")
    whole = save(concat_parts(parts), "audio_converted")
    converted = save(nlp_converted(raw), "audio_converted_v2")
    partitioned = sink.save_partitioned(
        sink.with_partition(converted, F.col("site")),
        f"{database}.audio_partitioned",
        path=path("audio_partitioned"),
    )
    return {
        "audio_raw": raw,
        "audio_converted_parts": parts,
        "audio_converted": whole,
        "audio_converted_v2": converted,
        "audio_partitioned": partitioned,
    }
