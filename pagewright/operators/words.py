"""Word rows and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as X

WORD_COUNTS_SQL = """
    WITH counted AS (SELECT word, count(*) AS n FROM {words} GROUP BY word),
    tested AS (
        SELECT word, CASE WHEN word RLIKE '[a-zA-Z]' AND NOT is_stop_word(lower(word)) THEN n END AS word_count
        FROM counted
    )
    SELECT {who} AS who, word, word_count FROM tested WHERE word_count IS NOT NULL
"""


def word_tokens(
    df: DataFrame,
    text: str = "text",
    keys: list[str] | None = None,
    keep_empty: bool = True,
    position: str | None = None,
) -> DataFrame:
    """One row per word, with the empty strings between neighbouring separators or without.

    ``position`` names a column for the word's place in its text, from 0.
    """
    split = X.words(F.col(text), keep_empty)
    if position is None:
        return df.select(*(keys or []), F.explode(split).alias("word"))
    return df.select(*(keys or []), F.posexplode(split).alias(position, "word"))


def word_extremes(
    df: DataFrame, text: str = "text", keys: list[str] | None = None, keep_empty: bool = True
) -> DataFrame:
    """One row per text: its smallest and largest word, ``first_word`` and ``last_word``, null if it has none.

    Spark sorts all rows of which it takes the smallest string of a group. Taken inside each text,
    that leaves a row per text to sort and not a row per word.
    """
    keys = keys or []
    split = df.select(*keys, X.words(F.col(text), keep_empty).alias("_words"))
    return split.select(*keys, F.array_min("_words").alias("first_word"), F.array_max("_words").alias("last_word"))


def word_counts(words: DataFrame, who: str) -> DataFrame:
    """Counts of the words that hold a letter and are no stop words, case kept.

    Words are counted first and tested once per distinct word. The test is tied to the
    count, else the optimizer would move it below the grouping and run it per row.
    """
    counts = words.groupBy("word").agg(F.count("word").alias("n"))
    wanted = F.col("word").rlike(X.HAS_LETTER) & ~X.is_stop_word(F.lower("word"))
    tested = counts.select(
        F.lit(who).alias("who"), "word", F.when(wanted, F.col("n")).otherwise(0).alias("word_count")
    )
    return tested.filter(F.col("word_count") > 0)


def word_counts_sql(words: DataFrame, who: str, view: str = "words") -> DataFrame:
    """``word_counts`` in SQL over a temporary view, with ``is_stop_word`` as a function."""
    spark = words.sparkSession
    X.register_stop_word_function(spark)
    words.createOrReplaceTempView(view)
    return spark.sql(WORD_COUNTS_SQL.format(who="'" + who.replace("'", "\\'") + "'", words=view))


def top_words(counts: DataFrame, k: int | None = None) -> DataFrame:
    """Most frequent words first, ties by word; all of them, or the first ``k``."""
    ordered = counts.orderBy(F.desc("word_count"), "word")
    return ordered if k is None else ordered.limit(k)
