"""Batch enrichment through an outside call, one call per distinct content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators.skew import heavy_keys, lookup_join
from pagewright.sinks.tables import materialize, path_exists

DEFAULT_THREADS = 20


def call_for_each(contents: DataFrame, content: str, function: Callable, threads: int) -> DataFrame:
    """Add ``result`` and ``error`` columns by calling ``function(content)`` per row.

    Calls of one Arrow batch overlap in a thread pool and come back in row order. A
    failing call fills ``error`` and leaves the other rows alone.
    """
    kept = [f for f in contents.schema.fields if f.name != content]
    names = [f.name for f in kept]

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        def attempt(value):
            try:
                return function(value), None
            except Exception as failure:
                return None, f"{type(failure).__name__}: {failure}"

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                answers = list(pool.map(attempt, batch[content]))
                out = batch[names].copy()
                out["result"] = [a[0] for a in answers]
                out["error"] = [a[1] for a in answers]
                yield out

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    return contents.mapInPandas(run, ", ".join([*columns, "result string", "error string"]))


def dedup_enrich(
    df: DataFrame,
    content: str,
    function: Callable[[str], str],
    keys: list[str],
    threads: int = DEFAULT_THREADS,
) -> DataFrame:
    """Enrich every row, calling ``function`` once per distinct content of the table.

    Result: keys, result, error. Copies are counted away before and after the shuffle.
    The answers are written to the shared folder, so a lost executor does not repeat calls
    that were answered and the rest of the plan does not run them again; this is the one
    operator that starts a job when it is called. What joins back is a content hash with
    its answer, never the content, and contents that fill much of the table are salted
    in that join. Null content is not sent and gets null.
    """
    digest = F.sha2(F.col(content), 256)
    distinct = (
        df.filter(F.col(content).isNotNull())
        .groupBy(content)
        .agg(F.count("*").alias("copies"))
        .select(digest.alias("digest"), content, "copies")
    )
    answers = materialize(call_for_each(distinct, content, function, threads), "answers")
    rows = df.select(*keys, digest.alias("digest"))
    hot = heavy_keys(answers, "digest", "copies")
    joined = lookup_join(rows, answers.drop("copies"), ["digest"], hot)
    return joined.select(*keys, "result", "error")


#: Rows of an answer store: the last attempt at a content says what is known of it.
STORE_SCHEMA = "digest string, result string, error string, attempt int"


def stored_answers(spark: SparkSession, store: str) -> DataFrame:
    """What a store knows: one row per digest, its answer or else its last error, and the attempts made."""
    if not path_exists(spark, store):
        return spark.createDataFrame([], STORE_SCHEMA)
    rows = spark.read.schema(STORE_SCHEMA).parquet(store)
    # An answer comes before any error, and then the latest attempt; equal ones go by their text.
    best = F.max(F.struct(F.col("error").isNull().alias("ok"), "attempt", "result", "error"))
    return rows.groupBy("digest").agg(best.alias("b"), F.max("attempt").alias("attempt")).select("digest", "b.result", "b.error", "attempt")


def resume_enrich(
    df: DataFrame,
    content: str,
    function: Callable[[str], str],
    keys: list[str],
    store: str,
    retries: int = 0,
    slices: int = 1,
    threads: int = DEFAULT_THREADS,
) -> DataFrame:
    """``dedup_enrich`` that goes on where an earlier run stopped.

    ``store`` is a folder of answers keyed by the content's digest, in the shared storage. Contents
    it has an answer for are not sent again; those it has only errors for are tried once more,
    and up to ``retries`` times more in this run. The contents to send are taken in ``slices``,
    by digest, and each slice's answers are committed before the next one starts, so a run that
    dies repeats one slice at most. Two runs at a time on one store may send a content twice.

    Result: keys, result, error, attempts (calls made for the row's content so far). Null
    content is not sent and gets nulls.
    """
    spark = df.sparkSession
    digest = F.sha2(F.col(content), 256)
    # One copy of each content and its number of copies; the contents to send are read from here.
    distinct = (
        df.filter(F.col(content).isNotNull()).groupBy(content).agg(F.count("*").alias("copies")).select(digest.alias("digest"), content, "copies")
    )
    distinct = materialize(distinct, "contents")
    for attempt in range(retries + 1):
        known = materialize(stored_answers(spark, store), "known-answers")
        open_ = distinct.drop("copies").join(known.filter("error is null").select("digest"), "digest", "left_anti")
        sent = open_.join(known.select("digest", "attempt"), "digest", "left")
        if attempt and known.filter("error is not null").isEmpty():
            break
        for number in range(slices):
            part = sent.filter(F.pmod(F.xxhash64("digest"), F.lit(slices)) == number)
            answers = call_for_each(part, content, function, threads)
            told = answers.select("digest", "result", "error", (F.coalesce("attempt", F.lit(0)) + 1).alias("attempt"))
            told.write.mode("append").parquet(store)
    answers = stored_answers(spark, store)
    rows = df.select(*keys, digest.alias("digest"))
    joined = lookup_join(rows, answers, ["digest"], heavy_keys(distinct, "digest", "copies"))
    return joined.select(*keys, "result", "error", F.col("attempt").alias("attempts"))


def flaky_word_counter(fails_on: int) -> Callable[[str], str]:
    """``word_counter`` that fails for texts whose number of pieces ``fails_on`` divides, as a service may."""
    count = word_counter()

    def run(value):
        found = count(value)
        if int(found) % fails_on == 0:
            raise ValueError(f"no answer for {found} words")
        return found

    return run


def word_counter() -> Callable[[str], str]:
    """Deterministic stand-in for an outside service: pieces between runs of whitespace.

    Made by a call, so that it travels to the workers by value.
    """
    import re

    def count(value):
        return str(len(re.split("[ \t\n\r\f]+", value)))

    return count
