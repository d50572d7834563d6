"""Quality rules by distribution divergence, in column expressions only.

Every document gets two histograms: seven character classes, and counts of common function
words next to all other words. They are summed per language into references, and a document
is kept if for some language both of its Jensen-Shannon distances (base 2, 0 to 1) are within
their limits. Short documents say little about a distribution, so each test has a guard: it
passes below a least number of characters or words.

One pass over the texts writes the histograms to the shared folder; the references and the
verdict read that small table. A reference is made of the documents of a language that pass the
base rules, whatever their share of all documents, if they have at least ``reference_words`` words
together: fewer say as little about a distribution as a short document does. The references are
one small aggregated row, one entry for each language, which is broadcast.

A document must not vouch for itself. So only references of at least ``reference_docs`` documents
count for a verdict. A document of a language with fewer is judged by its characters alone, next
to any reference that counts, as nothing is known of its words. Where no reference has as many
documents, all of them count.

Defined cases: a null, empty or blank text has no words and fails the base rules; documents
without a language do not add to a reference but are compared with all; without any
reference the divergence tests pass; repeated rows each get a row; an empty table gives an
empty result; only id, text and language columns are looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.binding import let
from pagewright.llm.frames import written

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of the languages.
COMMON_WORDS = sorted(
    {
        *"the of and to in a is that for on with as it was be by".split(),
        *"le la de et les des en un du que qui dans pour par sur au".split(),
        *"der die und in den von zu das mit sich des auf ist dem nicht".split(),
        *"de la que el en y a los se del las un por con una".split(),
    }
)


@dataclass(frozen=True)
class Limits:
    """Production parameters of the divergence tests."""

    char_distance: float = 0.25
    word_distance: float = 0.3
    least_chars: int = 400
    least_words: int = 100
    reference_words: int = 100
    reference_docs: int = 20


def _repeat_words(words: Column) -> Column:
    """Words that lie in a run of ``WINDOW`` words found at least twice in the text."""

    def covered(starts: Column) -> Column:
        none = F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            starts,
            none,
            lambda acc, s: F.struct(
                (acc["total"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("total"), s.alias("last")
            ),
            lambda acc: acc["total"],
        )

    def among(pairs: Column) -> Column:
        twice = F.filter(
            pairs,
            lambda x, k: (F.get(pairs, k - 1)["run"].eqNullSafe(x["run"]) & (k > 0))
            | F.get(pairs, k + 1)["run"].eqNullSafe(x["run"]),
        )
        return covered(F.sort_array(F.transform(twice, lambda x: x["at"])))

    def of_runs(runs: Column) -> Column:
        pairs = F.sort_array(F.transform(runs, lambda run, k: F.struct(run.alias("run"), k.alias("at"))))
        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0)).otherwise(let(pairs, among))

    def of_hashes(hashes: Column) -> Column:
        # Runs are compared by a 64-bit hash within one text.
        starts = F.sequence(F.lit(1), F.size(hashes) - F.lit(WINDOW - 1))
        return let(F.transform(starts, lambda k: F.xxhash64(F.slice(hashes, k, WINDOW))), of_runs)

    hashed = let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(hashed).cast("bigint")


def histograms(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Per document: id, lang, the base counts, and the two histograms as arrays."""
    removed = [
        ("no_lower", "text", "[a-z]+"),
        ("no_blank", "no_lower", BLANK_RUN),
        ("no_upper", "no_blank", "[A-Z]+"),
        ("no_digit", "no_upper", "[0-9]+"),
        ("no_mark", "no_digit", r"""[.,;:!?'"()\-]+"""),
        ("no_ascii", "no_mark", r"[\x00-\x7F]+"),
    ]
    step = docs.select(
        F.col(id_col).alias("id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    for name, source, pattern in removed:
        step = step.withColumn(name, F.regexp_replace(source, pattern, ""))
    trimmed = F.trim(F.col("text"), F.lit(BLANKS))
    step = step.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN)))
    step = step.withColumn("common", F.filter("words", lambda w: w.isin(COMMON_WORDS)))
    lines = F.filter(F.split("text", "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != "")
    sizes = [F.length(c) for c in ("text", *(name for name, _, _ in removed))]
    classes = [a - b for a, b in zip(sizes, sizes[1:], strict=False)] + [sizes[-1]]
    each = [F.size("common") - F.size(F.array_remove("common", w)) for w in COMMON_WORDS]
    return step.select(
        "id",
        "lang",
        F.size("words").cast("bigint").alias("n_words"),
        (sizes[0] - (sizes[1] - sizes[2])).cast("bigint").alias("word_chars"),
        (F.length("no_mark") - F.length(F.translate("no_mark", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        F.array(*classes).cast("array<bigint>").alias("chars"),
        F.array(*each, F.size("words") - F.size("common")).cast("array<bigint>").alias("common"),
    )


def references(counted: DataFrame, least_words: int, least_docs: int) -> DataFrame:
    """One row with ``refs``: (lang, character shares, word shares, whether it counts) of each language with enough words."""

    def shares(prefix: str, size: int) -> Column:
        total = F.aggregate(F.array(*(F.col(f"{prefix}{k}") for k in range(size))), F.lit(0).cast("bigint"), lambda a, x: a + x)
        return F.array(*(F.col(f"{prefix}{k}") / total for k in range(size)))

    n_chars, n_words = 7, len(COMMON_WORDS) + 1
    sums = [F.sum(F.get("chars", F.lit(k))).alias(f"c{k}") for k in range(n_chars)]
    sums += [F.sum(F.get("common", F.lit(k))).alias(f"w{k}") for k in range(n_words)]
    sound = counted.where(F.col("lang").isNotNull() & ~_base_failed())
    rows = sound.groupBy("lang").agg(F.sum("n_words").alias("n"), F.count("*").alias("docs"), *sums)
    enough = rows.where(F.col("n") >= max(least_words, 1))
    counts = (F.col("docs") >= least_docs).alias("counts")
    entry = F.struct("lang", shares("c", n_chars).alias("chars"), shares("w", n_words).alias("words"), counts)
    return enough.agg(F.sort_array(F.collect_list(entry)).alias("refs"))


def _base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def js_distance(counts: Column, total: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, base 2, of counts from a reference distribution."""

    def part(p: Column, mid: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0)

    terms = F.zip_with(counts, reference, lambda n, q: let(n / total, lambda p: part(p, (p + q) / 2) + part(q, (p + q) / 2)))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()
) -> DataFrame:
    """Per document: id, base counts, ``base_failed``, ``kept``, the nearest language and its distances.

    The nearest language is the one with the least sum of both distances (the first by name
    on a tie); null for a document without words or where there is no reference.
    """
    counted = written(histograms(docs, id_col, text_col, lang_col), "quality")
    refs = written(references(counted, limits.reference_words, limits.reference_docs), "quality-references")
    base_failed = _base_failed()
    shape = "array<struct<word:double,char:double,lang:string,counts:boolean>>"
    all_chars = F.aggregate("chars", F.lit(0).cast("bigint"), lambda a, x: a + x)
    to_each = F.transform(
        "refs",
        lambda r: F.struct(
            js_distance(F.col("common"), F.col("n_words"), r["words"]).alias("word"),
            js_distance(F.col("chars"), F.col("all_chars"), r["chars"]).alias("char"),
            r["lang"].alias("lang"),
            r["counts"].alias("counts"),
        ),
    )
    measured = counted.crossJoin(F.broadcast(refs)).withColumn("all_chars", all_chars).withColumn(
        "distances", F.when(F.col("n_words") > 0, to_each).otherwise(F.array().cast(shape))
    )
    near_chars = lambda d: (F.col("word_chars") < limits.least_chars) | (d["char"] <= limits.char_distance)
    near_words = lambda d: (F.col("n_words") < limits.least_words) | (d["word"] <= limits.word_distance)
    any_counts = F.exists("refs", lambda r: r["counts"])
    own_counts = F.exists("refs", lambda r: r["counts"] & (r["lang"] == F.col("lang")))
    near = F.exists("distances", lambda d: near_chars(d) & near_words(d) & (d["counts"] | ~any_counts)) | (F.size("distances") == 0)
    # F.exists is null where nothing matches and the language is null.
    unknown = F.col("lang").isNotNull() & ~F.coalesce(own_counts, F.lit(False))
    near = near | (unknown & F.exists("distances", lambda d: near_chars(d) & d["counts"]))
    nearest = F.get(
        F.sort_array(
            F.transform("distances", lambda d: F.struct((d["word"] + d["char"]).alias("sum"), d["lang"].alias("lang"), d["char"].alias("char"), d["word"].alias("word")))
        ),
        F.lit(0),
    )
    return measured.withColumn("nearest", nearest).select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & near).alias("kept"),
        F.round("nearest.char", 6).alias("char_distance"),
        F.round("nearest.word", 6).alias("word_distance"),
    )
