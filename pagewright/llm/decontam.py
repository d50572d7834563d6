"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over token windows.

Every run of ``window`` words of an item is a window; an item with fewer words, but at least
one, is a single window of its own length. Documents are scanned by rolling hashes of word
runs, each hash hit is verified against the window's bytes, and every word inside an
occurrence is hit.

The set is broadcast in blocks of at most ``block_bytes`` of item text. A block is held as its
words' bytes and a few numbers for each window, about ten times its text in all, on the driver
and in each worker. With one block, the usual case, a document's row is scanned and cut in one
narrow step. With more, each block's hits are written to the shared folder before the next block
is collected: ids and spans alone, which the texts are joined with once at the end.

Defined cases: a null or word-less text has no words and no hits; null or word-less items
have no windows; items sharing a window are all reported; a repeated item id counts once;
a null item id cannot be reported and is left out; repeated document rows each get a row;
empty tables give empty results; columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.frames import id_type, map_texts, raw_bytes, written
from pagewright.llm.words import Words

WINDOW = 10
BLOCK_BYTES = 8 << 20

SPANS = "array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class WindowSet:
    """The different windows of a block of items, by size: sorted hashes, where their bytes stand, and their items.

    Windows of one size with equal hashes stand next to each other, and ``owners`` from
    ``first_owner[w]`` on are the items of window ``w``.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.item_ids = sorted({item_id for item_id, _ in items})
        number = {item_id: k for k, item_id in enumerate(self.item_ids)}
        parts: list[np.ndarray] = []
        by_size: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = {}
        at = 0
        for item_id, raw in items:
            words = Words(raw)
            size = min(window, len(words))
            if size:
                n = len(words) - size + 1
                owner = np.full(n, number[item_id], np.int32)
                by_size.setdefault(size, []).append((words.runs(size), at + words.starts[:n], at + words.ends[size - 1 :], owner))
                parts.append(words.data)
                at += len(words.data)
        self._bytes = np.concatenate(parts).tobytes() if parts else b""
        self.sizes = {size: self._distinct(*(np.concatenate(c) for c in zip(*found, strict=True))) for size, found in by_size.items()}

    def _distinct(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray) -> dict[str, np.ndarray]:
        """Windows with equal bytes become one."""
        order = np.lexsort([owners, hashes])
        hashes, starts, ends, owners = hashes[order], starts[order], ends[order], owners[order]
        same_hash = np.append(False, hashes[1:] == hashes[:-1])
        window = np.cumsum(~same_hash) - 1
        for k in np.flatnonzero(same_hash):
            if self._bytes[starts[k] : ends[k]] != self._bytes[starts[k - 1] : ends[k - 1]]:
                return self._distinct_by_bytes(hashes, starts, ends, owners)
        first = np.flatnonzero(~same_hash)
        kept = np.append(True, (np.diff(window) != 0) | (np.diff(owners) != 0))
        return self._arrays(hashes[first], starts[first], ends[first], owners[kept], window[kept])

    def _distinct_by_bytes(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray) -> dict[str, np.ndarray]:
        """The same where two windows share a hash but not their bytes."""
        told = sorted(zip(hashes.tolist(), (self._bytes[a:b] for a, b in zip(starts, ends, strict=True)), owners.tolist(), starts.tolist(), ends.tolist(), strict=True))
        first, window, kept = [], [], []
        for row in told:
            if not first or row[:2] != first[-1][:2]:
                first.append(row)
            if not kept or (len(first) - 1, row[2]) != (window[-1], kept[-1]):
                window.append(len(first) - 1)
                kept.append(row[2])
        columns = [np.array([f[k] for f in first], t) for k, t in ((0, np.uint64), (3, np.int64), (4, np.int64))]
        return self._arrays(*columns, np.array(kept, np.int32), np.array(window))

    @staticmethod
    def _arrays(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray, window: np.ndarray) -> dict[str, np.ndarray]:
        first_owner = np.searchsorted(window, np.arange(len(hashes) + 1))
        return {"hashes": hashes, "starts": starts, "ends": ends, "owners": owners, "first_owner": first_owner}

    def scan(self, words: Words) -> tuple[np.ndarray, set[int]]:
        """A mark for each word that lies in an occurrence, and the items that occur."""
        edges = np.zeros(len(words) + 1, np.int32)
        items: set[int] = set()
        for size, found in self.sizes.items():
            runs = words.runs(size)
            if not len(runs):
                continue
            hashes = found["hashes"]
            at = np.searchsorted(hashes, runs)
            hits = np.flatnonzero(hashes[np.minimum(at, len(hashes) - 1)] == runs)
            seen: set[int] = set()
            for first, k in zip(hits.tolist(), at[hits].tolist(), strict=True):
                text = words.bytes_of(first, size)
                while k < len(hashes) and hashes[k] == runs[first]:
                    if self._bytes[found["starts"][k] : found["ends"][k]] == text:
                        edges[first] += 1
                        edges[first + size] -= 1
                        seen.add(k)
                        break
                    k += 1
            for k in seen:
                items.update(found["owners"][found["first_owner"][k] : found["first_owner"][k + 1]].tolist())
        return np.cumsum(edges[:-1]) > 0, items


def _as_spans(marks: np.ndarray) -> list[dict]:
    edges = np.diff(marks.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    return [
        {"start": int(a), "end": int(b)}
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)
    ]


def _without(raw: bytes, words: Words, marks: np.ndarray) -> bytes:
    """The text without its hit words and what separates them."""
    kept = np.ones(len(raw), bool)
    for span in _as_spans(marks):
        kept[words.text_starts[span["start"]] : words.text_ends[span["end"] - 1]] = False
    return np.frombuffer(raw, np.uint8)[kept].tobytes()


def _blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> Iterator[tuple[bool, list[tuple[str, bytes]]]]:
    """Whether it is the last, and the items of each block; a single empty one without items."""
    rows = items.select(
        F.col(item_id).cast("string").alias("item_id"), F.col(item_text).cast("binary").alias("raw")
    ).where("item_id is not null and raw is not null")
    total = rows.agg(F.coalesce(F.sum(F.length("raw") + 64), F.lit(0))).first()[0]
    count = max(-(-total // block_bytes), 1)
    for block in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "raw"), F.lit(count)) == block)
        yield block == count - 1, [(row.item_id, bytes(row.raw)) for row in part.collect()]


def _spans_to_marks(words: Words, spans: list[dict] | None) -> np.ndarray:
    marks = np.zeros(len(words), bool)
    for span in spans or ():
        marks[span["start"] : span["end"]] = True
    return marks


def _result(batch: pa.RecordBatch, found: list[tuple[bytes, Words, np.ndarray, list[str]]], clean: bool) -> pa.RecordBatch:
    texts = [(_without(raw, words, marks) if marks.any() else raw).decode("utf-8", "replace") if clean else None for raw, words, marks, _ in found]
    columns = [
        batch.column("id"),
        batch.column("row"),
        pa.array([len(words) for _, words, _, _ in found], pa.int64()),
        pa.array([_as_spans(marks) for _, _, marks, _ in found], _SPANS),
        pa.array([items for _, _, _, items in found], pa.list_(pa.string())),
        pa.array(texts, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["id", "row", "n_words", "spans", "items", "cleaned"])


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    clean: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """Per document: id, n_words, spans of hit words (ends excluded), items, and the cleaned text (null unless ``clean``).

    ``row`` holds the columns of ``keep``.
    """
    kind = id_type(docs, id_col)
    row = F.struct(*(keep or [id_col])).alias("row")
    schema = f"id {kind}, row {docs.select(row).schema['row'].dataType.simpleString()}, n_words bigint, spans {SPANS}, items array<string>, cleaned string"
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("twin"), row)
    hits: DataFrame | None = None
    for last, block in _blocks(items, item_id_col, item_text_col, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(WindowSet(block, window))
        if last and hits is None:
            break
        part = _block_hits(texts, shared, kind)
        if not last:
            part = written(part, "contamination-hits")
            shared.unpersist()
        hits = part if hits is None else hits.union(part)

    if hits is None:

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows: WindowSet = shared.value
            for batch in batches:
                found = []
                for raw in raw_bytes(batch.column("text")):
                    words = Words(raw)
                    marks, hits = windows.scan(words)
                    found.append((raw, words, marks, sorted(windows.item_ids[k] for k in hits)))
                yield _result(batch, found, clean)

        out = map_texts(texts, {name: F.col(name) for name in ("id", "row", "text")}, schema, scan)
        return out.withColumnRenamed("id", id_col)

    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(f"all_{c}")
    told = hits.groupBy("of_id", "of_twin").agg(flat("spans"), flat("items"))
    joined = texts.join(told, texts["id"].eqNullSafe(told["of_id"]) & (texts["twin"] == told["of_twin"]), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("all_spans", "all_items")]
            for raw, spans, owners in zip(raw_bytes(batch.column("text")), *columns, strict=True):
                words = Words(raw)
                found.append((raw, words, _spans_to_marks(words, spans), owners or []))
            yield _result(batch, found, clean)

    inputs = {name: F.col(name) for name in ("id", "row", "text", "all_spans", "all_items")}
    return map_texts(joined, inputs, schema, cut).withColumnRenamed("id", id_col)


def _block_hits(texts: DataFrame, shared: Broadcast, kind: str) -> DataFrame:
    """(of_id, of_twin, spans, items) of the documents that hold windows of a block; ``twin`` tells texts of one id apart."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: WindowSet = shared.value
        for batch in batches:
            rows, spans, items = [], [], []
            for k, raw in enumerate(raw_bytes(batch.column("text"))):
                marks, hits = windows.scan(Words(raw))
                if hits:
                    rows.append(k)
                    spans.append(_as_spans(marks))
                    items.append(sorted(windows.item_ids[h] for h in hits))
            at = pa.array(rows, pa.int64())
            columns = [pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("twin").take(at), *columns], ["of_id", "of_twin", "spans", "items"])

    inputs = {name: F.col(name) for name in ("id", "twin", "text")}
    # Repeated rows are found as often as they stand in the table; one is enough.
    return map_texts(texts, inputs, f"of_id {kind}, of_twin bigint, spans {SPANS}, items array<string>", scan).dropDuplicates(["of_id", "of_twin"])


def contamination_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The result of the query: counts and digests per document."""
    found = find_contamination(docs, items, id_col, clean=False)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + (s["end"] - s["start"]))
    return found.select(
        F.col(id_col).alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def remove_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with hit words cut out of the texts; documents left without a word go.

    A document without any hit is kept as it is, even if it has no words.
    """
    columns = docs.columns
    # The text comes back as it was or cut, so it is not carried along; a null text comes back as null.
    others = [c for c in columns if c != text_col]
    blank = docs.withColumn("__null", F.col(text_col).isNull()) if "__null" not in columns else docs
    found = find_contamination(blank, items, id_col, text_col, keep=[*others, "__null"])
    hit = F.size("spans") > 0
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + (s["end"] - s["start"]))
    values = {c: F.col(f"row.`{c}`") for c in others} | {text_col: F.when(~F.col("row.__null"), F.col("cleaned"))}
    if "n_chars" in columns:
        values["n_chars"] = F.when(hit, F.length("cleaned").cast(id_type(docs, "n_chars"))).otherwise(F.col("row.n_chars"))
    return found.where(~hit | (covered < F.col("n_words"))).select(*(values[c].alias(c) for c in columns))
