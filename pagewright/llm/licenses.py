"""License scan by ordered signature rules.

Texts are read as lowered words. One pass of an Aho-Corasick automaton over a text finds which
keywords it holds, and only the rules of those keywords run their expressions. Detections are
word ranges; one that lies within another of higher priority, or within a longer or earlier
ruled one of the same priority, is suppressed, so that "gpl 2" inside a full grant, or a bare
name inside a named version, does not count twice.

Beside the rules three fixed phrases are looked up as they are; their labels always stay.

The score is the greatest priority among the detections that stay, over 100 (a fixed phrase
counts as 90), and 0 without any.

Defined cases: a null or word-less text has no words and no labels; repeated rows each get a
row; empty tables give empty results; columns other than id and text are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.frames import id_type, map_texts, raw_bytes
from pagewright.llm.license_rules import RULES
from pagewright.llm.words import WORD_BYTES

#: Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
PHRASE_PRIORITY = 90

DETECTIONS = "array<struct<label:string,first:bigint,last:bigint,priority:int>>"
_DETECTIONS = pa.list_(
    pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("priority", pa.int32())])
)


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    priority: int
    keyword: str
    pattern: re.Pattern[str]


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    found = []
    for order, line in enumerate(x for x in RULES.splitlines() if x.strip()):
        label, priority, keyword, pattern = (part.strip() for part in line.split(" | ", 3))
        found.append(Rule(order, label, int(priority), keyword, re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")))
    return found


@lru_cache(maxsize=1)
def _prefilter() -> tuple[ahocorasick.Automaton, dict[str, list[Rule]]]:
    gated: dict[str, list[Rule]] = {}
    for rule in rules():
        gated.setdefault(rule.keyword, []).append(rule)
    automaton = ahocorasick.Automaton()
    for keyword in [*gated, *PHRASES]:
        automaton.add_word(f" {keyword} ", keyword)
    automaton.make_automaton()
    return automaton, gated


def spoken(raw: bytes) -> str:
    """The lowered words of a text with a space before, between and after them."""
    return (b" " + b" ".join(raw.translate(WORD_BYTES).split()) + b" ").decode("utf-8", "replace")


def unsuppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections (first, last word, rule) that lie within no stronger one."""
    order = sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[2].order, d[0]))
    kept: list[tuple[int, int, Rule]] = []
    reach: list[tuple[int, int]] = []  # kept ranges by first word, each reaching beyond those before it
    for first, last, rule in order:
        at = bisect_right(reach, (first, float("inf"))) - 1
        if at >= 0 and reach[at][1] >= last:
            continue
        kept.append((first, last, rule))
        # Ranges that the new one covers add nothing; the rest stay in order of both ends.
        at += 1
        while at < len(reach) and reach[at][1] <= last:
            reach.pop(at)
        if at > 0 and reach[at - 1][0] == first:
            reach.pop(at - 1)
        insort(reach, (first, last))
    return sorted(kept, key=lambda d: (d[0], d[1], d[2].order))


def scan(text: str) -> tuple[list[tuple[int, int, Rule]], list[tuple[int, str]]]:
    """Detections that stay, and (first word, label) of each place of a fixed phrase."""
    automaton, gated = _prefilter()
    keywords = {keyword for _, keyword in automaton.iter(text)}
    if not keywords:
        return [], []
    body = text[1:-1]
    ranges = []
    for keyword in keywords:
        for rule in gated.get(keyword, ()):
            for match in rule.pattern.finditer(body):
                ranges.append((match.start(), match.end(), rule))
    places = []
    for phrase, label in PHRASES.items():
        if phrase in keywords:
            at = text.find(f" {phrase} ")
            while at >= 0:
                places.append((at, label))
                at = text.find(f" {phrase} ", at + 1)
    # Word numbers of all these places in one walk over the text.
    offsets = sorted({a for a, _, _ in ranges} | {b for _, b, _ in ranges} | {a for a, _ in places})
    number, before, count = {}, 0, 0
    for offset in offsets:
        count += body.count(" ", before, offset)
        number[offset], before = count, offset
    found = [(number[a], number[b], rule) for a, b, rule in ranges]
    return unsuppressed(found), sorted((number[a], label) for a, label in places)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, detections (labelled word ranges), places of the fixed phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, detections, places = [], [], []
            for raw in raw_bytes(batch.column("text")):
                text = spoken(raw)
                n_words.append(text.count(" ") - 1 if len(text) > 2 else 0)
                found, base = scan(text)
                detections.append([{"label": r.label, "first": a, "last": b, "priority": r.priority} for a, b, r in found])
                places.append([{"label": label, "first": a, "last": a, "priority": PHRASE_PRIORITY} for a, label in base])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(detections, _DETECTIONS), pa.array(places, _DETECTIONS)],
                ["id", "n_words", "detections", "phrases"],
            )

    inputs = {"id": F.col(id_col), "text": F.col(text_col).cast("string")}
    schema = f"id {id_type(docs, id_col)}, n_words bigint, detections {DETECTIONS}, phrases {DETECTIONS}"
    return map_texts(docs, inputs, schema, run).withColumnRenamed("id", id_col)


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The result of the query: places of the fixed phrases, all labels, and a score."""
    found = scan_licenses(docs, id_col, text_col)
    labels = lambda c: F.transform(c, lambda d: d["label"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    both = F.concat("detections", "phrases")
    starts = F.transform("phrases", lambda d: d["first"])
    return found.select(
        F.col(id_col).alias("doc_id"),
        "n_words",
        F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(labels("phrases")).alias("base_labels"),
        joined(labels(both)).alias("labels"),
        F.coalesce(F.array_max(F.transform(both, lambda d: d["priority"])) / 100, F.lit(0.0)).alias("score"),
    )
