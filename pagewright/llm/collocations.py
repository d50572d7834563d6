"""Phrase collocations from suffix trees built group by group, by vertical partitioning.

Every word of a text opens a suffix, cut off at ``longest`` words and at the end of its piece. One
pass over the texts writes the distinct suffixes of each task with their counts, and all that
follows reads those. The suffixes of the whole corpus are divided by their prefixes so that each
group fits a memory budget, and every group builds its own depth-truncated subtree:

1. *Vertical partitioning.* Prefixes are classes of first words (by hash, per language), and their
   frequencies are counted over all documents. A class with more suffixes than the budget is
   extended by classes of the next word, as often as need be. Neighbouring prefixes are then
   grouped until the budget is full. The plan is at most ``CLASSES`` + ``longest`` x
   ``SUBCLASSES`` x (suffixes / budget) numbers, and the budget never goes below suffixes /
   ``MOST_GROUPS``, so the plan is bounded at any size and can be broadcast. What is over the
   budget at full depth is one phrase, or a few, repeated: its leaves are summed outright.
2. *Subtrees.* A group gets its leaves in blocks, merges them, and reads the counts of all nodes
   from leaf totals. Nodes above an extended prefix are spread over groups; their parts are added
   up.
3. *Scores.* Parts of a phrase are looked up among all counted phrases by joins, with frequent
   parts spread over salts. A part of a phrase is at least as frequent as the phrase, so phrases
   below ``least`` are not needed. Products are decimals of 38 digits.

Defined cases: a null text is empty; a null language is ``und``; empty pieces have no words;
repeated rows count each; empty tables give empty results; columns other than text and language
are not looked at. Ties of score and frequency go by the bytes of the phrase.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.frames import map_texts, raw_bytes, short_batches, written
from pagewright.operators.skew import hot_keys, lookup_join

UNDETERMINED = "und"
CLASSES, SUBCLASSES = 1 << 14, 1 << 6
MOST_GROUPS = 200_000
#: Words of a text that are looked at together; different words and leaves that a task holds; leaves of a block.
SLICE, HELD_WORDS, HELD, BLOCK = 1 << 17, 1 << 18, 1 << 20, 1 << 15
_MASK = (1 << 21) - 1
RANK_SALTS = 32
#: Bytes of an Arrow batch of leaf blocks, which are large rows.
BATCH_BYTES = 4 << 20
#: A-Z lowered, ends of pieces to a line break, a tab to a space.
PIECE_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x0A if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else b for b in range(256)
)
BREAK = b"\n"


@dataclass(frozen=True)
class Settings:
    """Production parameters."""

    longest: int = 3
    least: int = 10
    within: int = 50
    most: int = 2000
    budget: int = 1 << 19


class _Vocabulary(dict):
    """Numbers of words in the order in which they come; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


@dataclass
class Leaves:
    """Distinct truncated suffixes of one language: word numbers (a row for each, 0 where it has ended) and counts.

    ``words`` has the word of each number; the first stands for the end of a piece.
    """

    lang: str
    words: list[bytes]
    codes: np.ndarray
    counts: np.ndarray

    def first_classes(self) -> np.ndarray:
        """Class of each leaf's first word."""
        seed = xxhash.xxh32_intdigest(self.lang)
        return self._hashed(self.codes[:, 0], seed, CLASSES)

    def later_classes(self, at: np.ndarray, depth: int) -> np.ndarray:
        """Class of the word at ``depth`` of some leaves; 0 where they have ended."""
        codes = self.codes[at, depth]
        return np.where(codes > 0, self._hashed(codes, 0, SUBCLASSES), 0)

    def _hashed(self, codes: np.ndarray, seed: int, classes: int) -> np.ndarray:
        used, place = _renumbered(codes, len(self.words))
        of_word = np.array([xxhash.xxh3_64_intdigest(self.words[k], seed) % classes for k in used.tolist()], np.int64)
        return of_word[place] if len(codes) else codes

    def part(self, at: np.ndarray) -> Leaves:
        """Some of the leaves, with the words that they need."""
        if len(at) == len(self.codes):
            return self
        codes = self.codes[at]
        used, local = _renumbered(np.append(0, codes.ravel()), len(self.words))
        return Leaves(self.lang, [self.words[k] for k in used.tolist()], local[1:].reshape(codes.shape), self.counts[at])

    def packed(self) -> tuple[int, bytes, bytes, bytes]:
        """Number of leaves, words, codes, counts, in as few bytes as they need."""
        codes = self.codes.astype(np.uint16 if len(self.words) <= 1 << 16 else np.uint32)
        counts = self.counts.astype(np.uint16 if self.counts.max(initial=0) < 1 << 16 else np.int64)
        return len(codes), BREAK.join(self.words[1:]), codes.tobytes(), counts.tobytes()

    @classmethod
    def of(cls, lang: str, n: int, words: bytes, codes: bytes, counts: bytes, longest: int) -> Leaves:
        code = np.frombuffer(codes, np.uint16 if len(codes) == 2 * n * longest else np.uint32)
        count = np.frombuffer(counts, np.uint16 if len(counts) == 2 * n else np.int64)
        return cls(lang, [BREAK, *words.split(BREAK)], code.reshape(-1, longest).astype(np.int64), count.astype(np.int64))


def _renumbered(codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers below ``most`` that occur, in order, and each one's place among them."""
    seen = np.zeros(most, bool)
    seen[codes] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]


class Suffixes:
    """The distinct truncated suffixes of some texts, language by language."""

    def __init__(self, longest: int) -> None:
        self.longest = longest
        self.n_words: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self._held: dict[str, tuple[_Vocabulary, list[tuple[np.ndarray, np.ndarray]]]] = {}
        self._size = 0

    def add(self, batch: pa.RecordBatch) -> Iterator[None]:
        """Add the texts; pauses whenever what is held should be taken, after which it is forgotten."""
        by_language: dict[str, list[bytes]] = {}
        for lang, raw in zip(batch.column("lang").to_pylist(), raw_bytes(batch.column("text")), strict=True):
            by_language.setdefault(lang, []).append(raw)
        for lang, raws in by_language.items():
            raw = BREAK.join(raws).translate(PIECE_BYTES).replace(BREAK, b" \n ")
            tokens = list(filter(None, raw.split(b" ")))
            for start in range(0, len(tokens), SLICE):
                if self._size > HELD or sum(len(v) for v, _ in self._held.values()) > HELD_WORDS:
                    yield
                    self.clear()
                self._count(lang, tokens[start : start + SLICE + self.longest - 1], min(SLICE, len(tokens) - start))

    def _count(self, lang: str, tokens: list[bytes], n: int) -> None:
        vocabulary, parts = self._held.setdefault(lang, (_Vocabulary(), []))
        numbers = np.fromiter(map(vocabulary.__getitem__, tokens), np.int64, len(tokens))
        padded = np.concatenate([numbers, np.zeros(self.longest, np.int64)])
        starts = np.flatnonzero(numbers[:n])
        self.n_words[lang] = self.n_words.get(lang, 0) + len(starts)
        key = padded[starts]
        inside = np.ones(len(starts), bool)
        for k in range(1, self.longest):
            after = padded[starts + k]
            inside &= after > 0
            key = (key << 21) | np.where(inside, after, 0)
        parts.append(np.unique(key, return_counts=True))
        self._size += len(parts[-1][0])

    def leaves(self) -> Iterator[Leaves]:
        shifts = 21 * np.arange(self.longest - 1, -1, -1)
        for lang, (vocabulary, parts) in self._held.items():
            key, counts = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))
            if len(key):
                yield Leaves(lang, list(vocabulary), (key[:, None] >> shifts) & _MASK, counts)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


@dataclass
class Plan:
    """Group of each prefix. Level ``d`` has a row of classes for each extended prefix of level ``d - 1``.

    An entry is a group, or ``-2 - row`` where the prefix is extended to a row of the next
    level, or -1 where it is over the budget at full depth.
    """

    levels: list[np.ndarray]

    def groups(self, leaves: Leaves, depth: int | None = None) -> np.ndarray:
        """The entry of each leaf, down to level ``depth``."""
        found = self.levels[0][0, leaves.first_classes()]
        for k, level in enumerate(self.levels[1:depth], 1):
            extended = np.flatnonzero(found < -1)
            found[extended] = level[-2 - found[extended], leaves.later_classes(extended, k)]
        return found


_COLUMNS = [("prefix", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), *((c, pa.binary()) for c in ("words", "codes", "counts"))]
_LEAVES = ("lang", "n", "words", "codes", "counts")
_SCHEMA = "prefix bigint, lang string, n bigint, words binary, codes binary, counts binary"


def _rows(made: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*made, strict=True)) if made else [[]] * len(_COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, _COLUMNS, strict=True)], [n for n, _ in _COLUMNS])


def leaf_blocks(docs: DataFrame, text_col: str, lang_col: str, longest: int) -> DataFrame:
    """One pass over the texts, written: blocks of leaves (lang, n, words, codes, counts), the suffixes
    of each class of first words (prefix, n), and the words of each language (lang, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes, totals = Suffixes(longest), np.zeros(CLASSES, np.int64)

        def blocks() -> Iterator[pa.RecordBatch]:
            for leaves in suffixes.leaves():
                prefix = leaves.first_classes()
                np.add.at(totals, prefix, leaves.counts)
                # A block holds neighbouring prefixes, which mostly go to the same groups.
                order = np.argsort(prefix, kind="stable")
                for start in range(0, len(order), BLOCK):
                    yield _rows([(None, leaves.lang, *leaves.part(order[start : start + BLOCK]).packed())])

        for batch in batches:
            for _ in suffixes.add(batch):
                yield from blocks()
        yield from blocks()
        used = np.flatnonzero(totals)
        yield _rows([(k, None, n, None, None, None) for k, n in zip(used.tolist(), totals[used].tolist(), strict=True)])
        yield _rows([(None, lang, n, None, None, None) for lang, n in suffixes.n_words.items()])

    inputs = {"text": F.col(text_col).cast("string"), "lang": F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED))}
    return written(map_texts(docs, inputs, _SCHEMA, run), "phrase-leaves")


def _each(batch: pa.RecordBatch, longest: int) -> Iterator[Leaves]:
    for k in range(batch.num_rows):
        yield Leaves.of(*(batch.column(c)[k].as_py() for c in ("lang", "n", "words", "codes", "counts")), longest)


def vertical_partition(blocks: DataFrame, settings: Settings) -> Plan:
    """The groups of prefixes: classes over the budget are extended, one level after the other."""
    spark = blocks.sparkSession
    plan = Plan([])
    budget = settings.budget
    for depth in range(settings.longest):
        rows = 1 if depth == 0 else int((plan.levels[-1] < -1).sum())
        if not rows:
            break
        shared = spark.sparkContext.broadcast(plan)

        def count(batches: Iterator[pa.RecordBatch], depth=depth, shared=shared) -> Iterator[pa.RecordBatch]:
            totals: dict[int, int] = {}
            for batch in batches:
                for leaves in _each(batch, settings.longest):
                    row = shared.value.groups(leaves)
                    at = np.flatnonzero(row < -1)
                    prefix = (-2 - row[at]) * SUBCLASSES + leaves.later_classes(at, depth)
                    for key, n in zip(*(x.tolist() for x in _summed(prefix, leaves.counts[at])), strict=True):
                        totals[key] = totals.get(key, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())], ["prefix", "n"])

        if depth:
            inputs = {c: F.col(c) for c in _LEAVES}
            counted = map_texts(blocks.where("codes is not null"), inputs, "prefix bigint, n bigint", count)
        else:
            counted = blocks.where("prefix is not null").select("prefix", "n")
        # At most CLASSES rows, or SUBCLASSES for each of the prefixes over the budget.
        with short_batches(spark, size=BATCH_BYTES):
            totals = counted.groupBy("prefix").agg(F.sum("n").alias("n")).toArrow()
        level = np.zeros((rows, CLASSES if depth == 0 else SUBCLASSES), np.int64)
        level.ravel()[totals.column("prefix").to_numpy()] = totals.column("n").to_numpy()
        if depth == 0:
            budget = max(budget, -(-int(level.sum()) // MOST_GROUPS))
        plan.levels.append(_planned(level, budget, last=depth == settings.longest - 1, after=plan.levels))
        shared.unpersist()
    return plan


def _planned(totals: np.ndarray, budget: int, last: bool, after: list[np.ndarray]) -> np.ndarray:
    """Entries of a level from the number of suffixes of each prefix: neighbours share a group while it has room."""
    group = max([-1, *(int(level.max()) for level in after)]) + 1
    entries = np.zeros(totals.size, np.int64)
    held, extended = 0, 0
    for k, n in enumerate(totals.ravel().tolist()):
        if n > budget:
            entries[k] = -1 if last else -2 - extended
            extended += 1
            continue
        if held + n > budget:
            group, held = group + 1, 0
        entries[k] = group
        held += n
    return entries.reshape(totals.shape)


def grouped_blocks(blocks: DataFrame, plan: Plan, longest: int) -> DataFrame:
    """(prefix, lang, n, words, codes, counts): each block cut by groups, which ``prefix`` names; -1 is to be summed outright."""
    shared = blocks.sparkSession.sparkContext.broadcast(plan)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaves in _each(batch, longest):
                groups = shared.value.groups(leaves)
                order = np.argsort(groups, kind="stable")
                edges = np.flatnonzero(np.diff(groups[order])) + 1
                yield _rows([(int(groups[at[0]]), leaves.lang, *leaves.part(at).packed()) for at in np.split(order, edges)])

    return map_texts(blocks.where("codes is not null"), {c: F.col(c) for c in _LEAVES}, _SCHEMA, cut)


def subtree(blocks: list[Leaves], longest: int) -> list[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """The nodes of a subtree, depth by depth: all words, the word numbers along each node's path, and leaf totals."""
    number = _Vocabulary()
    paths = np.concatenate([np.fromiter(map(number.__getitem__, b.words), np.int64, len(b.words))[b.codes] for b in blocks])
    totals = np.concatenate([b.counts for b in blocks])
    names = list(number)
    nodes = []
    at = np.zeros(len(paths), np.int64)
    for depth in range(longest):
        alive = paths[:, depth] > 0
        paths, totals, at = paths[alive], totals[alive], at[alive]
        if not len(paths):
            break
        # A node is its parent and its last word; parents are numbered in the round before.
        key = (at << 32) | paths[:, depth]
        order = np.argsort(key, kind="stable")
        opens = np.append(True, np.diff(key[order]) != 0)
        first = np.flatnonzero(opens)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(opens) - 1
        nodes.append((names, paths[order[first], : depth + 1], np.add.reduceat(totals[order], first)))
    return nodes


def phrase_counts(docs: DataFrame, text_col: str, lang_col: str, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(lang, depth, phrase, f) of all phrases of up to ``longest`` words found ``least`` times, and (lang, n)."""
    longest, least = settings.longest, settings.least
    blocks = leaf_blocks(docs, text_col, lang_col, longest)
    plan = vertical_partition(blocks, settings)
    words = blocks.where("prefix is null and codes is null").groupBy("lang").agg(F.sum("n").alias("n"))
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    schema = "lang string, depth int, phrase string, n bigint, whole boolean"

    spread = any((level < 0).any() for level in plan.levels)

    def nodes_of(found: list[Leaves], complete: bool) -> pa.RecordBatch:
        lang = found[0].lang
        columns: list[list] = [[], [], [], []]
        for depth, (names, paths, totals) in enumerate(subtree(found, longest), 1):
            split = np.ones(len(paths), bool)
            if complete and spread:
                # A node is spread over groups if its prefix class was extended.
                padded = np.concatenate([paths, np.zeros((len(paths), longest - depth), np.int64)], axis=1)
                split = shared.value.groups(Leaves(lang, names, padded, totals), depth=depth) < 0
            elif complete:
                split = np.zeros(len(paths), bool)
            kept = np.flatnonzero(split | (totals >= least))
            columns[0] += [depth] * len(kept)
            columns[1] += [b" ".join([names[k] for k in path]).decode() for path in paths[kept].tolist()]
            columns[2] += totals[kept].tolist()
            columns[3] += (~split[kept]).tolist()
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(columns[0]), pa.string()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
            ["lang", "depth", "phrase", "n", "whole"],
        )

    def of_group(table: pa.Table) -> pa.Table:
        by_language: dict[str, list[Leaves]] = {}
        for batch in table.to_batches():
            for leaves in _each(batch, longest):
                by_language.setdefault(leaves.lang, []).append(leaves)
        return pa.Table.from_batches([nodes_of(found, True) for found in by_language.values()])

    def outright(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaves in _each(batch, longest):
                yield nodes_of([leaves], False)

    sent = grouped_blocks(blocks, plan, longest)
    nodes = sent.where("prefix >= 0").groupBy("prefix").applyInArrow(of_group, schema)
    if any((level == -1).any() for level in plan.levels):
        rest = sent.where("prefix < 0")
        nodes = nodes.union(map_texts(rest, {c: F.col(c) for c in _LEAVES}, schema, outright))
    nodes = written(nodes, "phrase-nodes", BATCH_BYTES)
    parts = nodes.where("not whole").groupBy("lang", "depth", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    every = nodes.where("whole").select("lang", "depth", "phrase", "n").union(parts)
    return written(every.withColumnRenamed("n", "f"), "phrase-counts"), words


def _key(lang: str, phrase: Column) -> Column:
    """One key of language and phrase, which never holds a line break."""
    return F.concat_ws("\n", F.col(lang), phrase)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a, l, r, n, score."""
    if not 2 <= settings.longest <= 3:
        raise ValueError("phrases have two or three words at most")
    counts, words = phrase_counts(docs, text_col, lang_col, settings)
    candidates = counts.where("depth > 1").select("lang", "depth", "phrase", F.col("f").alias("a"))
    parts = F.split("phrase", " ")
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("depth") - 1)))
    cut = cut.select("*", _key("lang", F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ")).alias("left"), _key("lang", F.array_join(F.slice(parts, F.col("k") + 1, F.col("depth")), " ")).alias("right"))
    known = counts.select(_key("lang", F.col("phrase")).alias("key"), "f")
    hot = {side: hot_keys(cut, side) for side in ("left", "right")}
    for side, name in (("left", "l"), ("right", "r")):
        cut = lookup_join(cut, known.select(F.col("key").alias(side), F.col("f").alias(name)), [side], hot[side], ["phrase", "k"])
    wide = {c: F.col(c).cast("decimal(20,0)") for c in ("a", "l", "r")}
    # Integers of up to 38 digits; the quotient is at most a million, as both parts are as frequent as the phrase.
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide["a"] * wide["a"]), wide["l"] * wide["r"])
    scored = cut.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "depth")).alias("s"))
    scored = scored.select("lang", "phrase", "s.score", "s.l", "s.r", "s.a")

    longer = candidates.where("depth > 2")
    at = F.sequence(F.lit(1), F.lit(2))
    inner = longer.select("lang", "a", F.explode(F.transform(at, lambda i: F.array_join(F.slice(parts, i, F.lit(2)), " "))).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(covered, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < settings.within * F.col("a"), F.lit(True)))

    order = [F.desc("score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS))
    some = kept.withColumn("salt", salt).withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    some = some.where(F.col("place") <= settings.most)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= settings.most)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
