"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

A text's n-grams of one to three characters, in lower case, with digits and signs as borders,
are hashed into ``1 << BITS`` features; their weights are 1 + log(count) times idf, scaled to
length one. Document frequencies are counted over all training documents. The weights of the
classes are learned by follow-the-regularised-leader with an elastic-net penalty, whose l1
part leaves most of them at zero, from a sample of training documents: of each language at most
``language_docs``, and fewer where all languages together would have more than ``sample_docs``,
taken by a hash of their id. So a rare language is learned from what there is of it, however
large the others are. One document in ``calibration_part`` of each language's sample is not learned
from but gives the temperature that makes the scores honest probabilities.

A language is learned if it is among the ``most_languages`` with the most training documents
(ties by name); a warning tells if there are more.

Learned from rows that are not held out and have a language; a held-out row's language is
never read. Texts are scored whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any
training row every text is ``und`` with score 0; with a single language every text with a
letter is that language; ties go to the language first by name; repeated rows each get a row;
empty tables give empty results; columns other than id, text and language are not looked at.
"""

from __future__ import annotations

import math
import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.frames import held_out, id_type, map_texts
from pagewright.llm.words import mixed

#: Documents with ``crc32(doc_id) % FOLDS == HELD`` are held out.
FOLDS, HELD = 3, 1
BITS = 16
SIZE = 1 << BITS
UNDETERMINED = "und"
SAMPLE_PARTS = 32


@dataclass(frozen=True)
class Settings:
    """Production parameters."""

    language_docs: int = 1250
    sample_docs: int = 40_000
    calibration_part: int = 5
    most_languages: int = 1000
    epochs: int = 2
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.002


def _letters(text: str) -> np.ndarray:
    """Code points of the lowered text; whatever is no letter is a space, once."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    ascii_letter = (points >= 97) & (points <= 122)
    other = points >= 0xAA
    if other.any():
        unusual, where = np.unique(points[other], return_inverse=True)
        other[other] = np.array([chr(p).isalpha() for p in unusual.tolist()])[where]
    letter = ascii_letter | other
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    return np.where(letter, points, 32)[kept]


def feature_counts(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(feature numbers, counts) of a text; None without a letter."""
    points = _letters(text).astype(np.uint64)
    if not len(points):
        return None
    points = np.concatenate([np.array([32], np.uint64), points, np.array([32], np.uint64)[: int(points[-1] != 32)]])
    counts = np.zeros(SIZE, np.int64)
    key = np.zeros(len(points), np.uint64)
    for n in (1, 2, 3):
        key = (key[: len(points) - n + 1] << np.uint64(21)) | points[n - 1 :]
        counts += np.bincount((mixed(key + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64), minlength=SIZE)
    at = np.flatnonzero(counts)
    return at, counts[at]


def _weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[at]
    return values / max(float(np.sqrt((values**2).sum())), 1e-12)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for a softmax over classes."""

    def __init__(self, size: int, classes: int, settings: Settings) -> None:
        self.z = np.zeros((size, classes))
        self.n = np.zeros((size, classes))
        self.settings = settings

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        s, z, n = self.settings, self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        logits = values @ w
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[label] -= 1
        slope = values[:, None] * p[None, :]
        step = (np.sqrt(self.n[at] + slope**2) - np.sqrt(self.n[at])) / self.settings.alpha
        self.z[at] += slope - step * w
        self.n[at] += slope**2


@dataclass
class Model:
    """``rows`` are the features that have a weight for some language, ``values`` their weights; the last row is the constant."""

    languages: list[str]
    idf: np.ndarray
    rows: np.ndarray
    values: np.ndarray
    temperature: float = 1.0

    @property
    def weights(self) -> np.ndarray:
        """Weights of all features, and of the constant at ``SIZE``."""
        dense = np.zeros((SIZE + 1, len(self.languages)))
        dense[np.append(self.rows, SIZE)] = self.values
        return dense

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.rows, at)
        known = np.flatnonzero(np.append(self.rows, -1)[place] == at)
        return _weighted(at, counts, self.idf)[known] @ self.values[place[known]] + self.values[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        found = feature_counts(text) if text else None
        if found is None or not self.languages:
            return UNDETERMINED, 0.0
        logits = self.logits(*found) / self.temperature
        p = np.exp(logits - logits.max())
        best = int(np.argmax(p))
        return self.languages[best], float(p[best] / p.sum())


def temperature_for(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm.

    A sample without errors would ask for ever less, so it never goes below a quarter.
    """

    def loss(log_t: float) -> float:
        scaled = logits / math.exp(log_t)
        scaled = scaled - scaled.max(1, keepdims=True)
        return float((np.log(np.exp(scaled).sum(1)) - scaled[np.arange(len(labels)), labels]).mean())

    low, high, ratio = math.log(0.25), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, settings: Settings) -> Model:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("id"), FOLDS, HELD) & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(SIZE, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = feature_counts(text)
                if found is not None:
                    counts[found[0]] += 1
                    n += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(counts[at], n), pa.int64())], ["feature", "n"])

    # At most SIZE + 1 rows, whatever the corpus.
    counted = map_texts(rows, {"text": F.col("text")}, "feature bigint, n bigint", frequencies).groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    df = dict(zip(counted.column("feature").to_pylist(), counted.column("n").to_pylist(), strict=True))
    total = df.pop(-1, 0)
    idf = np.full(SIZE, math.log(total + 1) + 1)
    for feature, n in df.items():
        idf[feature] = math.log((total + 1) / (n + 1)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ats, values = [], [], []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                found = feature_counts(text)
                if found is not None:
                    langs.append(lang)
                    ats.append(found[0].astype(np.int32).tobytes())
                    values.append(np.minimum(found[1], 1 << 30).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ats, pa.binary()), pa.array(values, pa.binary())], ["lang", "at", "counts"])

    # A document has at most SIZE features, so what comes to the driver is bounded by the parameters.
    taken = rows.join(F.broadcast(_chosen(rows, settings)), F.col("id").eqNullSafe(F.col("of_id")) & (F.xxhash64("text") == F.col("of_text")) & (F.col("lang") == F.col("of_lang")))
    made = map_texts(taken, {"text": F.col("text"), "lang": F.col("lang")}, "lang string, at binary, counts binary", vectors)
    sample = made.distinct().toArrow().to_pylist()
    # An order that follows neither language nor id.
    sample.sort(key=lambda r: (xxhash.xxh3_64_intdigest(r["at"] + r["counts"]), r["lang"]))
    return learned([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["counts"], np.int32), r["lang"]) for r in sample], idf, settings)


def _chosen(rows: DataFrame, settings: Settings) -> DataFrame:
    """(of_id, of_text, of_lang): the sample, at most ``language_docs`` of each language."""
    by_count = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(settings.most_languages + 1)
    languages = [r.lang for r in by_count.collect()]
    if len(languages) > settings.most_languages:
        warnings.warn(f"only the {settings.most_languages} languages with the most documents are learned", stacklevel=2)
        languages.pop()
    quota = max(1, min(settings.language_docs, settings.sample_docs // max(1, len(languages))))
    known = rows.sparkSession.createDataFrame([(x,) for x in languages], "of_lang string")
    keys = rows.select(F.col("id").alias("of_id"), F.xxhash64("text").alias("of_text"), F.col("lang").alias("of_lang")).distinct()
    keys = keys.join(F.broadcast(known), "of_lang")
    # A language may hold most documents: it is thinned out in parts first.
    order = [F.xxhash64("of_id"), "of_id", "of_text"]
    parts = keys.withColumn("part", F.pmod(F.xxhash64("of_text"), F.lit(SAMPLE_PARTS)))
    some = parts.withColumn("place", F.row_number().over(Window.partitionBy("of_lang", "part").orderBy(*order))).where(F.col("place") <= quota)
    ranked = some.withColumn("place", F.row_number().over(Window.partitionBy("of_lang").orderBy(*order))).where(F.col("place") <= quota)
    return ranked.select("of_id", "of_text", "of_lang")


def learned(sample: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray, settings: Settings) -> Model:
    """The model of (features, counts, language) rows; the first ones of each language are for calibration."""
    languages = sorted({lang for _, _, lang in sample})
    number = {lang: k for k, lang in enumerate(languages)}
    if not sample:
        return Model([], idf, np.zeros(0, np.int64), np.zeros((1, 0)))
    left = {lang: n // settings.calibration_part for lang, n in Counter(lang for _, _, lang in sample).items()}
    training, held = [], []
    for row in sample:
        (held if left[row[2]] else training).append(row)
        left[row[2]] = max(0, left[row[2]] - 1)
    used = np.unique(np.concatenate([at for at, _, _ in sample]))
    learner = Ftrl(len(used) + 1, len(languages), settings)
    for _ in range(settings.epochs):
        for at, counts, lang in training:
            learner.learn(np.append(np.searchsorted(used, at), len(used)), np.append(_weighted(at, counts, idf), 1.0), number[lang])
    weights = learner.weights(slice(None))
    some = np.flatnonzero((weights[:-1] != 0).any(1))
    model = Model(languages, idf, used[some], weights[np.append(some, len(used))])
    if held and len(languages) > 1:
        logits = np.array([model.logits(at, counts) for at, counts, _ in held])
        model.temperature = temperature_for(logits, np.array([number[lang] for _, _, lang in held]))
    return model


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """Per document: id, ``held_out``, ``lang_pred`` and its probability ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col, lang_col, settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(text) for text in batch.column("text").to_pylist()]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), langs, scores], ["id", "lang_pred", "score"])

    inputs = {"id": F.col(id_col), "text": F.col(text_col).cast("string")}
    found = map_texts(docs, inputs, f"id {id_type(docs, id_col)}, lang_pred string, score double", run)
    return found.select(F.col("id").alias(id_col), held_out(F.col("id"), FOLDS, HELD).alias("held_out"), "lang_pred", "score")
