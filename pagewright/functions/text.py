"""Text expressions: strip, markers, words, stop words, padding."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Word separators and the pattern a word must contain. The separators are
# [^a-zA-Z\d:] written as ranges: the JVM matches a negated class of several ranges about
# five times slower.
WORD_SEPARATOR = r"[\x00-/;-@\[-`{-\x{10FFFF}]"
WORD = r"[a-zA-Z\d:]+"
HAS_LETTER = "[a-zA-Z]+"

# English stop words, in their usual order, contractions and their
# fragments last.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them
their theirs themselves what which who whom this that that'll these those am is are was
were be been being have has had having do does did doing a an the and but if or because
as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there
when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don don't should should've now d ll m o re ve y
ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# The markers put around a text before it is encoded.
START_MARKER = "[CLS] "
END_MARKER = "[SEP]"
PAD_TOKEN = "[PAD]"


def strip(text: Column) -> Column:
    """Remove all leading and trailing Unicode whitespace (``trim`` removes spaces only)."""
    return F.trim(text, F.lit(WHITESPACE))


def wrap_markers(text: Column) -> Column:
    """``[CLS] text[SEP]``; null stays null."""
    return F.concat(F.lit(START_MARKER), text, F.lit(END_MARKER))


def words(text: Column, keep_empty: bool = True) -> Column:
    """Array of words; runs of separators give empty strings, as a plain split does."""
    if keep_empty:
        return F.split(text, WORD_SEPARATOR)
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def is_stop_word(word: Column) -> Column:
    """True for null and for listed words; matching is exact, so lower-case first."""
    return F.coalesce(word.isin(STOP_WORDS), F.lit(True))


def register_stop_word_function(spark: SparkSession, name: str = "is_stop_word") -> None:
    """Make ``is_stop_word(string)`` callable from SQL.

    It is a SQL function, so the optimizer inlines it: no Python worker is started.
    """
    listed = ", ".join("'" + w.replace("'", "\\'") + "'" for w in STOP_WORDS)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(word STRING) RETURNS BOOLEAN "
        f"RETURN coalesce(word IN ({listed}), true)"
    )


def tokens(text: Column, first: int | None = None) -> Column:
    """Lower-case word tokens (ASCII letters, digits, underscore), without empty ones.

    With ``first``, only that many: splitting stops there and does not cut up the rest.
    """
    # One piece more for an empty one ahead of the first token, one for the rest.
    limit = -1 if first is None else first + 2
    found = F.filter(F.split(F.lower(text), r"\W+", limit), lambda t: t != "")
    return found if first is None else F.slice(found, 1, first)


def pad_truncate(token_array: Column, length: int, pad: str = PAD_TOKEN) -> Column:
    """Array of exactly ``length`` tokens: longer ones are cut, shorter ones padded."""
    padded = F.concat(token_array, F.array_repeat(F.lit(pad), length))
    return F.slice(padded, 1, length)


def speech_text(text: Column, language: Column) -> Column:
    """Deterministic stand-in for a recognizer: one part of a recording to plain text.

    Runs of whitespace become one space. ``language`` is the literal argument a remote
    recognizer would get; a null language gives null.
    """
    return F.when(language.isNotNull(), strip(F.regexp_replace(text, r"[ \t\n\r\f]+", " ")))
