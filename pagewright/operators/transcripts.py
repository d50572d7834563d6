"""Segments of timed signals, chunks of segments, and text put together again in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.functions import packing as P

# Index values whose parts are sorted and joined together before the key's blocks are.
BLOCK = 1024


def concat_parts(
    parts: DataFrame,
    key: str = "url",
    index: str = "chunk_index",
    text: str = "speech_as_text",
    output: str = "converted_texts",
) -> DataFrame:
    """Texts of each key joined by a space in index order: one row (key, output) per key.

    Neighbouring parts are sorted and joined in blocks of index values first, by many tasks
    for a long key; then the blocks of a key are joined in order. Indices may be sparse;
    parts with the same index go by their text. Null texts are skipped, a key without
    any text gives ''.
    """

    def joined(position: Column, piece: Column) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(position.alias("i"), piece.alias("t"))))
        return F.array_join(F.transform(ordered, lambda p: p["t"]), " ")

    block = F.floor(F.col(index) / BLOCK).cast("bigint")
    blocks = parts.groupBy(key, block.alias("_block")).agg(
        F.when(F.count(text) > 0, joined(F.col(index), F.col(text))).alias("_joined")
    )
    return blocks.groupBy(key).agg(joined(F.col("_block"), F.col("_joined")).alias(output))


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a timestamp; a zoneless one counts as UTC.

    Zoneless values are measured by subtraction, so the session time zone has no say.
    """
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        since = F.col(column) - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
        seconds = since.cast("interval second").cast("decimal(20,6)")
        return (seconds * 1_000_000).cast("bigint")
    return F.unix_micros(column)


# Gap-wide slots whose events are put in order together; see ``gap_segments``.
SLOTS_PER_BUCKET = 4096


def gap_segments(
    events: DataFrame, key: str, ts: str, gap_micros: int, slots_per_bucket: int = SLOTS_PER_BUCKET
) -> DataFrame:
    """Split each key's events where the silence exceeds the gap.

    Result: key, segment_id from 0, n_events, start_micros, end_micros.

    Two events in the same gap-wide time slot are never split, so events are first
    counted per (key, slot), most of it before the shuffle. Slots are put in order within
    (key, bucket of ``slots_per_bucket`` slots), so a task never sees more than that of one
    key, however small the gap. Buckets of a key are then joined by their first and last
    times alone: a bucket's first segment goes on with the last of the bucket before if
    the silence between them is within the gap. Events without a time form one segment of
    their own, ahead of the others.
    """
    timed = events.select(F.col(key).alias("k"), micros(events, ts).alias("t"))
    slot_start = F.col("t") - F.pmod(F.col("t"), F.lit(gap_micros))
    bucket = F.floor(F.col("slot") / F.lit(gap_micros * slots_per_bucket)).cast("bigint")
    slots = (
        timed.groupBy("k", slot_start.alias("slot"))
        .agg(F.count("*").alias("n"), F.min("t").alias("first"), F.max("t").alias("last"))
        .withColumn("bucket", bucket)
    )
    within = Window.partitionBy("k", "bucket").orderBy("slot")
    silence = F.col("first") - F.lag("last").over(within)
    opens = F.coalesce((silence > gap_micros).cast("int"), F.lit(1))
    pieces = (
        slots.withColumn("opens", opens)
        .withColumn("piece", F.sum("opens").over(within))
        .groupBy("k", "bucket", "piece")
        .agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    buckets = pieces.groupBy("k", "bucket").agg(
        F.max("piece").alias("pieces"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    across = Window.partitionBy("k").orderBy("bucket")
    goes_on = F.coalesce(F.col("first") - F.lag("last").over(across) <= gap_micros, F.lit(False))
    numbered = buckets.withColumn("new", F.col("pieces") - goes_on.cast("int")).withColumn(
        "before", F.sum("new").over(across) - F.col("pieces")
    )
    offsets = numbered.select(F.col("k").alias("_k"), F.col("bucket").alias("_bucket"), "before")
    same = F.col("k").eqNullSafe(F.col("_k")) & F.col("bucket").eqNullSafe(F.col("_bucket"))
    return (
        pieces.join(offsets, same)
        .groupBy(F.col("k").alias(key), (F.col("before") + F.col("piece") - 1).alias("segment_id"))
        .agg(
            F.sum("n").alias("n_events"),
            F.min("first").alias("start_micros"),
            F.max("last").alias("end_micros"),
        )
    )


def non_empty_lines(text: str) -> Column:
    return F.filter(F.split(F.col(text), "\n"), lambda line: F.length(line) > 0)


def pack_lines(
    documents: DataFrame, key: str, text: str = "text", budget: int = 400
) -> DataFrame:
    """Lines of each document packed into chunks: (key, chunk_index, chunk, n_chars, n_lines)."""
    chunks = P.pack_segments(non_empty_lines(text), budget)
    rows = documents.select(key, F.posexplode(chunks).alias("chunk_index", "c"))
    return rows.select(
        key,
        "chunk_index",
        F.col("c.text").alias("chunk"),
        F.col("c.length").alias("n_chars"),
        F.col("c.n_segments").alias("n_lines"),
    )
