"""Toxicity by a noisy channel: disguised words are decoded first, then the text is scored.

Channel: a letter may be written as a digit or sign, repeated, or followed by a filler, and the
letters of a word may stand apart. A word with such writings is a lattice of letters, and the
likeliest path under a character model of order four is its reading (see ``letters``). The
character model counts the letters of all documents, labelled or not. A token is read as one
lattice and split at its signs, and the most toxic reading counts. Numbers and addresses are not
decoded. A lattice none of whose paths spells a feature is not decoded either, which changes no
score.

Score: toxic words and word beginnings are those that labelled toxic documents hold far more
often than labelled clean ones. Whole toxic words are also looked for inside longer words, of any
length, if labelled clean documents hardly ever hold them there. A logistic regression over a
document's share of them gives the score. All is learned from at most ``train_docs`` labelled
documents, taken by a hash of their id among those that are not held out; the toxic share of the
sample is that of the labels.

Defined cases: null and empty texts hold no toxic word and get the lowest score; without labels
of both kinds every score is the toxic share of the labels (0 without labels); repeated and
contradicting labels of an id count once, as toxic if any is; repeated rows each get a row;
empty tables give empty results; columns other than ids, text and label are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import letters
from pagewright.llm.frames import held_out, id_type, map_texts, written

#: Documents with ``crc32(doc_id) % FOLDS == 0`` are held out.
FOLDS = 5
#: Characters of tokens and words that a scorer remembers in a worker; several scorers may live there.
REMEMBERED = 4 << 20
#: Letters of a word that is looked for inside others, at least.
LEAST_INNER = 4


@dataclass(frozen=True)
class Settings:
    """Production parameters."""

    train_docs: int = 40_000
    least_docs: int = 5
    least_share: float = 0.005
    least_z: float = 3.0
    least_lift: float = math.log(5)


class Memory(dict):
    """What a worker has found out about strings; forgets all of it when they have too many characters."""

    def __init__(self) -> None:
        super().__init__()
        self._size = 0

    def keep(self, key: str, value: str | float) -> None:
        self._size += len(key) + (len(value) if isinstance(value, str) else 0) + 64
        if self._size > REMEMBERED:
            self.clear()
            self._size = 0
        self[key] = value


class Inside:
    """Finds words inside the readings of a token."""

    def __init__(self, words: Iterable[str]) -> None:
        self._words = sorted(words)
        self._reach = letters.Reach(self._words, anywhere=True)
        self._found = ahocorasick.Automaton()
        for word in self._words:
            self._found.add_word(word, word)
        if self._words:
            self._found.make_automaton()

    def of(self, token: str, decode: Callable[[str], str]) -> set[str]:
        if not self._words:
            return set()
        read = [token, *(decode(w) for w in letters.lattices(token)[1] if self._reach.may(w))]
        return {word for text in read for _, word in self._found.iter(text)}


@dataclass
class Scorer:
    """Lifts of word features and of words inside others (as whole ones, if not given), and the regression over a document's summary."""

    model: letters.LetterModel
    lifts: dict[str, float] = field(default_factory=dict)
    inner: dict[str, float] | None = None
    weights: np.ndarray | None = None
    constant: float = 0.0
    _read: Memory = field(default_factory=Memory)
    _known: Memory = field(default_factory=Memory)
    _finders: tuple | None = None

    def decode(self, word: str) -> str:
        found = self._read.get(word)
        if found is None:
            found = self.model.decode(word)
            self._read.keep(word, found)
        return found

    def finders(self) -> tuple[letters.Gate, letters.Reach, Inside]:
        """What tells which tokens to read and which lattices to decode for ``lifts``, and what finds the words of ``inner``."""
        if self._finders is None:
            if self.inner is None:
                self.inner = {f[:-1]: x for f, x in self.lifts.items() if f.endswith("$") and len(f) > LEAST_INNER}
            self._finders = (letters.Gate([*self.lifts, *self.inner]), letters.Reach(self.lifts), Inside(self.inner))
        return self._finders

    def lift(self, token: str) -> float:
        found = self._known.get(token)
        if found is None:
            _, reach, inside = self.finders()
            words = letters.readings_within(token, self.decode, reach)
            found = max((self.word_lift(w) for w in words), default=0.0)
            found = max([found, *(self.inner[w] for w in inside.of(token, self.decode))])
            self._known.keep(token, found)
        return found

    def word_lift(self, word: str) -> float:
        return max((self.lifts.get(f, 0.0) for f in features(word)), default=0.0)

    def summary(self, text: str) -> list[float]:
        """Of the different toxic words: summed lifts, greatest lift, number; and the text's size."""
        lowered = text.lower()
        gate, reach, _ = self.finders()
        hits = [x for x in map(self.lift, gate.tokens(lowered)) if x > 0]
        hits += [x for x in (self.word_lift(self.decode(w)) for w in letters.spaced_words(lowered) if reach.may(w)) if x > 0]
        return [math.fsum(hits), max(hits, default=0.0), float(len(hits)), math.log1p(len(set(lowered.split())))]

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.constant
        z = float(np.dot(self.weights, [1.0, *self.summary(text)]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def features(word: str) -> list[str]:
    """A word and its beginnings, by which inflected forms are known."""
    if len(word) < 3:
        return []
    return [word + "$", *(word[:k] for k in (4, 5, 6) if len(word) >= k)]


def letter_model(docs: DataFrame, text_col: str) -> letters.LetterModel:
    """The character model of all texts: runs of letters, counted in the tasks first."""
    size = letters.SYMBOLS**letters.ORDER

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            letters.gram_counts([t or "" for t in batch.column("text").to_pylist()], counts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["gram", "n"])

    found = map_texts(docs, {"text": F.col(text_col).cast("string")}, "gram bigint, n bigint", count)
    # At most SYMBOLS ** ORDER rows, whatever the corpus.
    rows = found.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.int64)
    counts[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    return letters.LetterModel(counts)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str, most: int) -> DataFrame:
    """(text, toxic) of the training documents, written."""
    usable = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(label_id), FOLDS, 0))
    each = usable.groupBy(F.col(label_id).alias("label_id")).agg(F.max((F.col(label_col) == 1).cast("int")).alias("toxic"))
    taken = each.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
    # The sample has at most ``most`` ids, so it can be sent to every task.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.join(F.broadcast(taken), F.col("id") == F.col("label_id")).select("text", "toxic"), "toxicity-sample")


def _counted(sample: DataFrame, found_in: Callable[[str], set[str]]) -> DataFrame:
    """(feature, n): documents of the sample in which it is found."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(found_in(text or ""))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["feature", "n"])

    return map_texts(sample, {"text": F.col("text")}, "feature string, n bigint", count).groupBy("feature").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=1)
def _finders_for(wanted: frozenset[str], words: tuple[str, ...]) -> tuple[letters.Gate, letters.Reach, Inside]:
    return letters.Gate([*wanted, *words]), letters.Reach(wanted), Inside(words)


def _features_of(words: Iterable[str]) -> set[str]:
    return {f for w in words for f in features(w)}


def learn_lifts(sample: DataFrame, scorer: Scorer, toxic: int, clean: int, settings: Settings) -> None:
    """Set ``lifts`` and ``inner`` from a sample of so many toxic and clean documents.

    In clean documents, features are first counted in words of letters only, as they are written.
    That alone rules most of them out; only for the others are clean documents read in all ways.
    """
    spark = sample.sparkSession
    shared = spark.sparkContext.broadcast(scorer)
    bad, good = sample.where("toxic = 1"), sample.where("toxic = 0")

    def in_all_readings(text: str) -> set[str]:
        return _features_of(letters.words_restored(text, shared.value.decode))

    # Features of at least so many of at most ``train_docs`` documents: bounded by the parameters.
    least = max(settings.least_docs, settings.least_share * toxic)
    often = {r.feature: r.n for r in _counted(bad, in_all_readings).where(F.col("n") >= least).collect()}

    def share(a: int, b: int) -> float:
        """Logarithm of how much more often toxic documents hold something."""
        return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))

    def lift(a: int, b: int) -> float:
        """``share``, or 0 if it is small or may be chance."""
        found = share(a, b)
        sure = found / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= settings.least_z
        return found if sure and found >= settings.least_lift else 0.0

    wanted = spark.sparkContext.broadcast(frozenset(often))

    def as_written(text: str) -> set[str]:
        return _features_of(filter(str.isalpha, set(text.lower().split()))) & wanted.value

    written_counts = {r.feature: r.n for r in _counted(good, as_written).collect()}
    # More documents can only lower a share, so what is too low already stays so.
    left = {f: a for f, a in often.items() if share(a, written_counts.get(f, 0)) >= settings.least_lift}
    words = [f[:-1] for f in left if f.endswith("$") and len(f) > LEAST_INNER]
    looked_for = spark.sparkContext.broadcast((frozenset(left), words))

    def in_likely_readings(text: str) -> set[str]:
        scorer, (wanted, words) = shared.value, looked_for.value
        gate, reach, inside = _finders_for(wanted, tuple(words))
        lowered = text.lower()
        tokens = gate.tokens(lowered)
        read = {w for t in tokens for w in letters.readings_within(t, scorer.decode, reach)}
        read |= {scorer.decode(w) for w in letters.spaced_words(lowered) if reach.may(w)}
        return (_features_of(read) & wanted) | {"*" + w for t in tokens for w in inside.of(t, scorer.decode)}

    among_clean = {r.feature: r.n for r in _counted(good, in_likely_readings).collect()}
    scorer.lifts = {f: x for f, a in left.items() if (x := lift(a, among_clean.get(f, 0)))}
    inside = {w: lift(often[w + "$"], among_clean.get("*" + w, 0)) for w in words if w + "$" in scorer.lifts}
    scorer.inner = {w: min(x, scorer.lifts[w + "$"]) for w, x in inside.items() if x}


def fitted(rows: np.ndarray, toxic: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method on standardised columns; the constant comes first."""
    mean, spread = rows.mean(0), np.maximum(rows.std(0), 1e-9)
    x = np.column_stack([np.ones(len(rows)), (rows - mean) / spread])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-9, *[ridge * len(rows)] * rows.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - toxic) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    scaled = w[1:] / spread
    return np.array([w[0] - scaled @ mean, *scaled])


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str, settings: Settings) -> Scorer:
    scorer = Scorer(letter_model(docs, text_col))
    sample = _sample(docs, labels, id_col, text_col, label_id, label_col, settings.train_docs)
    n = {row.toxic: row.n for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        scorer.constant = float(toxic > 0)
        return scorer
    learn_lifts(sample, scorer, toxic, clean, settings)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [shared.value.summary(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"])

    rows = map_texts(sample, {"text": F.col("text"), "toxic": F.col("toxic")}, "x array<double>, toxic int", summaries).toArrow()
    x = np.array(rows.column("x").to_pylist())
    y = rows.column("toxic").to_numpy().astype(float)
    order = np.lexsort([y, *x.T])
    scorer.weights = fitted(x[order], y[order])
    return scorer


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "toxic",
    settings: Settings = Settings(),
    keep: list[str] | None = None,
    with_text: bool = False,
) -> DataFrame:
    """Per document: id, ``held_out``, ``score``, ``predicted``; ``row`` with the columns of ``keep``, and ``text`` (null unless asked for)."""
    scorer = train(docs, labels, id_col, text_col, label_id, label_col, settings)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    row = F.struct(*(keep or [id_col]))
    kind = docs.select(row.alias("row")).schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([shared.value.score(t or "") for t in batch.column("text").to_pylist()], pa.float64())
            text = batch.column("text") if with_text else pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), scores, text], ["id", "row", "score", "text"])

    inputs = {"id": F.col(id_col), "row": row, "text": F.col(text_col).cast("string")}
    found = map_texts(docs, inputs, f"id {id_type(docs, id_col)}, row {kind}, score double, text string", run)
    return found.select(
        F.col("id").alias(id_col),
        held_out(F.col("id"), FOLDS, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "row",
        "text",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are predicted toxic."""
    # The text is sent to the workers once, apart from the other columns.
    others = [c for c in docs.columns if c != text_col]
    found = toxicity(docs, labels, id_col, text_col, keep=others, with_text=True)
    values = {c: F.col(f"row.`{c}`") for c in others} | {text_col: F.col("text")}
    return found.where("predicted = 0").select(*(values[c].alias(c) for c in docs.columns))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The result of the query."""
    return toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")
