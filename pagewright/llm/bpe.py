"""BPE encoding and decoding with a lexicon automaton for frequent words.

The vocabulary file of a public tokenizer gives the ids, the merges, and the steps around them:
special tokens are cut out first, the rest is put into NFC, runs of white space become a space,
letters are lowered one by one, a pattern picks the words, and a word's UTF-8 bytes are merged
pair by pair, the last one marked as a word's end.

The frequent words of the corpus, counted over all documents, are merged once, on the driver,
and compiled into a minimal acyclic transducer (see ``lexicon``), which is broadcast as bytes
and mapped from a file by each Python worker. It holds at most ``lexicon_words`` words of at
most ``longest_word`` bytes, whatever the corpus. Words it does not hold are merged exactly
where they occur. The ids are the same with any lexicon or none.

Defined cases: a null text is empty; an empty text has no ids and decodes to an empty text;
repeated rows each get a row; empty tables give empty results; columns other than id and text
are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.frames import id_type, map_texts, written
from pagewright.llm.lexicon import Lexicon, compiled

LEXICON_WORDS = 50_000
LONGEST_WORD = 64
#: Steps in which counts are told apart between a power of two and the next.
COUNT_STEPS = 8
#: Different words that a task counts before it passes its counts on.
COUNTED_AT_ONCE = 200_000
#: Different words whose ids a task keeps at hand.
REMEMBERED = 300_000
#: Up to this many bytes a word's merges are found by looking at all of its pairs.
SHORT_WORD = 100
_ID = (1 << 20) - 1
_NO_MERGE = 1 << 62


#: Points from here on are rare, and classes that hold them are slow to match.
_RARE = 0x10000
_HAS_RARE = re.compile("[\U00010000-\U0010ffff]")


@lru_cache(maxsize=2)
def _classes(end: int) -> tuple[str, str]:
    """Unicode's letters and numbers below ``end`` as ranges of a character class."""
    found: dict[str, list[list[int]]] = {"L": [], "N": []}
    for point in range(end):
        kind = unicodedata.category(chr(point))[0]
        if kind in found:
            ranges = found[kind]
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    return tuple("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in found[k]) for k in "LN")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Ids, merges and text steps of a tokenizer file."""

    def __init__(self, source: str) -> None:
        told = json.loads(source)
        model = told["model"]
        steps = told["normalizer"]["normalizers"]
        plain = {"dropout": None, "unk_token": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or any(model.get(k, v) != v for k, v in plain.items()):
            raise ValueError("a tokenizer file with other steps than those implemented here")
        split = told["pre_tokenizer"]["pretokenizers"][0]
        spaces = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # Unicode's white space
        pattern = split["pattern"]["Regex"].replace(r"\s", spaces)

        def compiled_for(end: int) -> re.Pattern[str]:
            letters, numbers = _classes(end)
            return re.compile(pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers))

        self.pattern, self._full_pattern = compiled_for(_RARE), compiled_for(0x110000)
        self.ids: dict[str, int] = model["vocab"]
        self._inner = [self.ids[x] for x in _byte_letters()]
        self._last = [self.ids[x + model["end_of_word_suffix"]] for x in _byte_letters()]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        # Both ids of a pair in one number, and the merge's rank with the new id in another.
        self.merges: dict[int, int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges.setdefault(self.ids[left] << 20 | self.ids[right], rank << 20 | self.ids[left + right])
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}

    def parts(self, text: str) -> list[str | int]:
        """Words in order; a special token as its id."""
        out: list[str | int] = []
        for k, piece in enumerate(self._special.split(text)) if "<" in text else ((0, text),):
            if k % 2:
                out.append(self.special[piece])
            else:
                if not piece.isascii():
                    # Letter by letter: lower() alone would look at a sigma's neighbours.
                    piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
                piece = piece.lower()
                plain = piece.isascii() or not _HAS_RARE.search(piece)
                # No word holds white space, so there is no need to put it in order first.
                out += (self.pattern if plain else self._full_pattern).findall(piece)
        return out

    def merged(self, word: str) -> list[int]:
        """The ids of one word: always the merge that comes first, the leftmost on a tie."""
        raw = word.encode()
        ids = [self._inner[b] for b in raw]
        ids[-1] = self._last[raw[-1]]
        if len(ids) > SHORT_WORD:
            return self._merged_by_queue(ids)
        get = self.merges.get
        found = [get(a << 20 | b, _NO_MERGE) for a, b in zip(ids, ids[1:], strict=False)]
        while found:
            best = min(found)
            if best == _NO_MERGE:
                break
            k = found.index(best)
            ids[k : k + 2] = [best & _ID]
            del found[k]
            if k:
                found[k - 1] = get(ids[k - 1] << 20 | ids[k], _NO_MERGE)
            if k < len(found):
                found[k] = get(ids[k] << 20 | ids[k + 1], _NO_MERGE)
        return ids

    def _merged_by_queue(self, ids: list[int]) -> list[int]:
        """The same for long words, whose cost must not grow with the square of the length."""
        get, n = self.merges.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def propose(k: int) -> None:
            if k >= 0 and after[k] < n and (m := get(ids[k] << 20 | ids[after[k]])) is not None:
                heapq.heappush(queue, (m, k, ids[k], ids[after[k]]))

        for k in range(n):
            propose(k)
        while queue:
            merge, k, left, right = heapq.heappop(queue)
            nxt = after[k]
            if ids[k] != left or nxt >= n or ids[nxt] != right:
                continue
            ids[k], ids[nxt] = merge & _ID, -1
            after[k] = after[nxt]
            if after[k] < n:
                before[after[k]] = k
            propose(before[k])
            propose(k)
        return [i for i in ids if i >= 0]

    def decoded(self, ids: list[int]) -> str:
        return " ".join(self.tokens[i] for i in ids)


@lru_cache(maxsize=2)
def _vocabulary(source: str) -> Vocabulary:
    return Vocabulary(source)


@lru_cache(maxsize=2)
def _lexicon(block: bytes, name: str) -> Lexicon:
    return Lexicon.of_bytes(block, name)


def frequent_words(docs: DataFrame, text_col: str, source: str, most: int = LEXICON_WORDS, longest: int = LONGEST_WORD) -> list[str]:
    """The ``most`` frequent words of all texts (ties by word), counted in the tasks first."""
    shared = docs.sparkSession.sparkContext.broadcast(source)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value)
        counts: Counter[str | int] = Counter()

        def flushed() -> pa.RecordBatch:
            rows = [(w, n) for w, n in counts.items() if isinstance(w, str) and len(w.encode()) <= longest]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(vocabulary.parts(text or ""))
            if len(counts) >= COUNTED_AT_ONCE:
                yield flushed()
        yield flushed()

    found = map_texts(docs, {"text": F.col(text_col).cast("string")}, "word string, n bigint", count)
    counted = written(found.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    # Words below a count that ``most`` others reach are not among the first; few of the others are sent.
    step = F.floor(F.log2("n") * COUNT_STEPS).cast("int")
    steps = counted.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    least, enough = 1, 0
    for row in sorted(steps, key=lambda r: -r.step):
        least, enough = row.least, enough + row.words
        if enough >= most:
            break
    top = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most)
    return [row.word for row in top.collect()]


def encode(
    docs: DataFrame,
    vocabulary_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lexicon_words: int = LEXICON_WORDS,
    longest_word: int = LONGEST_WORD,
    with_ids: bool = True,
    with_decoded: bool = True,
) -> DataFrame:
    """Per document: id, n_tokens, ids_sha256, decoded_sha256, ids, decoded text (the last two null unless asked for)."""
    spark: SparkSession = docs.sparkSession
    with open(vocabulary_file, encoding="utf-8") as file:
        source = file.read()
    vocabulary = Vocabulary(source)
    words = frequent_words(docs, text_col, source, lexicon_words, longest_word)
    block = compiled({w.encode(): vocabulary.merged(w) for w in words})
    shared = spark.sparkContext.broadcast((source, block, hashlib.sha256(block).hexdigest()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, block, name = shared.value
        vocabulary, lexicon = _vocabulary(source), _lexicon(block, name)
        coded: dict[str | int, bytes] = {}
        read: dict[str | int, str] = {}
        for batch in batches:
            if len(coded) > REMEMBERED:
                coded.clear()
                read.clear()
            texts = [vocabulary.parts(text or "") for text in batch.column("text").to_pylist()]
            new = set().union(*texts).difference(coded)
            spelled = [w for w in new if isinstance(w, str)]
            coded.update((w, np.uint32(w).tobytes()) for w in new if isinstance(w, int))
            for word, rank in zip(spelled, lexicon.ranks([w.encode() for w in spelled]).tolist(), strict=True):
                coded[word] = lexicon.ids_of_rank(rank) if rank >= 0 else np.array(vocabulary.merged(word), np.uint32).tobytes()
            read.update((w, vocabulary.decoded(np.frombuffer(coded[w], np.uint32).tolist())) for w in new)
            counts, digests, decoded_digests, all_ids, all_decoded = [], [], [], [], []
            for parts in texts:
                raw = b"".join([coded[w] for w in parts])
                decoded = " ".join([read[w] for w in parts])
                counts.append(len(raw) // 4)
                digests.append(hashlib.sha256(raw).hexdigest())
                decoded_digests.append(hashlib.sha256(decoded.encode()).hexdigest())
                all_ids.append(np.frombuffer(raw, np.int32) if with_ids else None)
                all_decoded.append(decoded if with_decoded else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(decoded_digests, pa.string()),
                    pa.array(all_ids, pa.list_(pa.int32())),
                    pa.array(all_decoded, pa.string()),
                ],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"],
            )

    schema = f"id {id_type(docs, id_col)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string"
    inputs = {"id": F.col(id_col), "text": F.col(text_col).cast("string")}
    return map_texts(docs, inputs, schema, run).withColumnRenamed("id", id_col)


def decode(rows: DataFrame, vocabulary_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and the text of its ids; null ids are none."""
    with open(vocabulary_file, encoding="utf-8") as file:
        shared = rows.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value)
        for batch in batches:
            texts = [vocabulary.decoded(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "decoded"])

    inputs = {"id": F.col(id_col), "ids": F.col(ids_col)}
    return map_texts(rows, inputs, f"id {id_type(rows, id_col)}, decoded string", run).withColumnRenamed("id", id_col)


def token_report(docs: DataFrame, vocabulary_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The result of the query: token counts and digests."""
    found = encode(docs, vocabulary_file, id_col, text_col, with_ids=False, with_decoded=False)
    return found.select(F.col(id_col).alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
