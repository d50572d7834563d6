"""Ranked lexical search by NRA over impact-sorted postings.

Items are queries, documents are ranked. A document scores, for each term of an item,
``w * (10^9 tf div (1000 tf + 8 m))``, where ``w`` falls with the number of documents that hold
the term and ``m`` rises with the document's length; all but ``w`` is integer arithmetic.

1. One pass cuts every document into terms and keeps those that an item has, with their counts.
   Document frequencies and lengths over all documents come from that table.
2. The documents are dealt over tasks, and each task indexes its own, some at a time: a term's
   postings go by falling impact. For every item NRA reads its terms' lists side by side and only
   onwards, in growing steps. A document has a lower bound, the impacts read so far, and an upper
   one, which adds for each list without it the last impact read there. Documents not met have the
   sum of those. Reading goes on until no document that may still be among the first ``most`` has
   different bounds, nor can one not met be among them; equal scores count as possible, so
   members, ties and scores are final. What a task found before is a bar for what it reads next.
3. The first ``most`` of an item in all tasks are the first of those first in each task.

Items are taken in blocks of at most ``block_bytes`` of text, one after the other, so the terms
that are broadcast are bounded whatever the number of items.

Defined cases: a null or term-less document has no terms, is not counted and never found; an item
without terms, or whose terms no document holds, has no rows; a term that an item repeats counts
once; items that share an id are ranked each on its own; repeated document rows are documents of
their own; among equal scores null document ids come last; empty tables give empty results;
columns other than ids and texts are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.frames import id_type, map_texts, raw_bytes, written
from pagewright.llm.words import WORD_BYTES

MOST = 10
BLOCK_BYTES = 4 << 20
#: Documents and postings that a task indexes at a time.
INDEX_DOCS, INDEX_POSTINGS = 1 << 15, 1 << 21
#: Postings of each list in the first step; a step is twice the one before.
FIRST_STEP = 64
RANK_SALTS = 32


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a text in order: runs of digits, letters and bytes beyond ASCII, A-Z lowered."""
    return raw.translate(WORD_BYTES).split()


def term_weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64)


def length_factors(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """``100 - 90 + 90 n N div L`` of each document."""
    if len(lengths) and 90 * int(lengths.max()) * documents >= 1 << 63:
        return np.array([10 + 90 * n * documents // terms for n in lengths.tolist()], np.int64)
    return 10 + 90 * lengths * documents // max(terms, 1)


def impacts(weights: np.ndarray, counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return weights * (1_000_000_000 * counts // (1000 * counts + 8 * factors))


@dataclass
class ImpactIndex:
    """Postings of some documents: for each term its documents by falling impact.

    The postings of term ``t`` are those from ``starts[t]`` to ``starts[t + 1]``.
    """

    starts: np.ndarray
    documents: np.ndarray
    impacts: np.ndarray
    size: int

    @classmethod
    def of(cls, terms: np.ndarray, documents: np.ndarray, found: np.ndarray, n_terms: int, size: int) -> ImpactIndex:
        kept = found > 0
        terms, documents, found = terms[kept], documents[kept], found[kept]
        order = np.lexsort([documents, -found, terms])
        return cls(np.searchsorted(terms[order], np.arange(n_terms + 1)), documents[order], found[order], size)

    def nra(self, terms: np.ndarray, most: int, bar: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, postings read) of all that may be among the first ``most`` with at least ``bar``.

        The scores are final, and every document left out is below ``bar`` or below ``most`` others.
        """
        at, ends = self.starts[terms].copy(), self.starts[terms + 1]
        last = np.where(at < ends, self.impacts[np.minimum(at, max(len(self.impacts) - 1, 0))] if len(self.impacts) else 0, 0)
        lower = np.zeros(self.size, np.int64)
        missing = np.ones((len(terms), self.size), bool)
        alive = np.zeros(0, np.int64)
        met = np.zeros(self.size, bool)
        step, read = FIRST_STEP, 0
        while True:
            for k in np.flatnonzero(at < ends):
                stop = min(at[k] + step, ends[k])
                found = self.documents[at[k] : stop]
                lower[found] += self.impacts[at[k] : stop]
                missing[k, found] = False
                new = found[~met[found]]
                met[new] = True
                alive = np.concatenate([alive, new])
                read += stop - at[k]
                at[k] = stop
                last[k] = self.impacts[stop - 1] if stop < ends[k] else 0
            if len(alive) >= most:
                bar = max(bar, int(np.partition(lower[alive], len(alive) - most)[len(alive) - most]))
            upper = lower[alive] + last @ missing[:, alive]
            # Bounds only come closer, so what is below the bar once stays there.
            alive, upper = alive[upper >= bar], upper[upper >= bar]
            unmet = int(last.sum())
            if (unmet < bar or unmet == 0) and (upper == lower[alive]).all():
                return alive, lower[alive], read
            step *= 2


class Best:
    """The first ``most`` documents of an item so far: greater scores, then smaller ids, null ids last."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.rows: list[tuple[int, object]] = []

    def bar(self) -> int:
        return self.rows[-1][0] if len(self.rows) == self.most else 1

    def add(self, found: list[tuple[int, object]]) -> None:
        self.rows = sorted([*self.rows, *found], key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))[: self.most]


def _item_blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    """Items with a text, in blocks that come to the driver one at a time."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").cast("binary").alias("raw")).where("raw is not null")
    total = rows.agg(F.coalesce(F.sum(F.length("raw") + 64), F.lit(0))).first()[0]
    count = max(-(-total // block_bytes), 1)
    for block in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "raw"), F.lit(count)) == block)
        yield [(row.item_id, bytes(row.raw)) for row in part.collect()]


def _forward(docs: DataFrame, id_col: str, text_col: str, number: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts) of each document that has terms: all its terms, and those among ``number``."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            sizes, found = [], []
            for raw in raw_bytes(batch.column("text")):
                terms = terms_of(raw)
                sizes.append(len(terms))
                counts = Counter(filter(None, map(number.get, terms)))
                found.append((list(counts), list(counts.values())))
            columns = [
                batch.column("id"),
                pa.array(sizes, pa.int64()),
                pa.array([f[0] for f in found], pa.list_(pa.int32())),
                pa.array([f[1] for f in found], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "counts"]).filter(pa.array([s > 0 for s in sizes], pa.bool_()))

    inputs = {"id": F.col(id_col), "text": F.col(text_col).cast("string")}
    schema = f"id {id_type(docs, id_col)}, n bigint, terms array<int>, counts array<int>"
    return written(map_texts(docs, inputs, schema, run), "search-terms")


def rank_block(
    docs: DataFrame, items: list[tuple[object, bytes]], id_col: str = "doc_id", text_col: str = "text", most: int = MOST
) -> DataFrame:
    """(item, id, score): the first ``most`` documents of each item in each task; ``item`` is its place in ``items``."""
    spark = docs.sparkSession
    of_item = [sorted(set(terms_of(raw))) for _, raw in items]
    # Numbers begin at 1.
    number = {t: k for k, t in enumerate(sorted({t for terms in of_item for t in terms}), 1)}
    forward = _forward(docs, id_col, text_col, number)
    totals = forward.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # A row for each term of the block at most.
    counted = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    frequencies = np.zeros(len(number) + 1, np.int64)
    frequencies[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
    queries = [np.array([number[t] for t in terms if frequencies[number[t]]], np.int64) for terms in of_item]
    shared = spark.sparkContext.broadcast((queries, term_weights(frequencies, totals.documents), totals.documents, totals.terms))
    kind = id_type(docs, id_col)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, documents, terms = shared.value
        best = [Best(most) for _ in queries]
        ids_kind = None

        def index(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            counts = table.column("counts").combine_chunks()
            of_term = table.column("terms").combine_chunks().flatten().to_numpy().astype(np.int64)
            place = np.repeat(np.arange(len(counts)), np.diff(counts.offsets.to_numpy()))
            factors = length_factors(table.column("n").to_numpy(), documents, terms)
            found = impacts(weights[of_term], counts.flatten().to_numpy().astype(np.int64), factors[place])
            postings = ImpactIndex.of(of_term, place, found, len(weights), len(counts))
            ids = table.column("id")
            for query, own in zip(queries, best, strict=True):
                if len(query):
                    rows, scores, _ = postings.nra(query, most, own.bar())
                    if len(rows):
                        own.add(list(zip(scores.tolist(), ids.take(pa.array(rows)).to_pylist(), strict=True)))

        held: list[pa.RecordBatch] = []
        size = n = 0
        for batch in batches:
            ids_kind = batch.column("id").type
            held.append(batch)
            size += len(batch.column("terms").flatten())
            n += batch.num_rows
            if size >= INDEX_POSTINGS or n >= INDEX_DOCS:
                index(held)
                held, size, n = [], 0, 0
        if held:
            index(held)
        if ids_kind is not None:
            rows = [(k, i, score) for k, own in enumerate(best) for score, i in own.rows]
            columns = [[r[j] for r in rows] for j in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), ids_kind, pa.int64()), strict=True)], ["item", "id", "score"]
            )

    inputs = {c: F.col(c) for c in ("id", "n", "terms", "counts")}
    return map_texts(forward, inputs, f"item bigint, id {kind}, score bigint", search)


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    most: int = MOST,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each item's first ``most`` documents: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    item_kind = items.schema[item_id_col].dataType.simpleString()
    order = [F.desc("score"), F.asc_nulls_last("id")]
    out: DataFrame | None = None
    for block in _item_blocks(items, item_id_col, item_text_col, block_bytes):
        found = rank_block(docs, block, id_col, text_col, most)
        salted = found.withColumn("salt", F.pmod(F.xxhash64("id", "score"), F.lit(RANK_SALTS)))
        some = salted.withColumn("place", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("place") <= most)
        ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= most)
        ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], f"item bigint, item_id {item_kind}")
        # No more rows than items of the block.
        named = ranked.join(F.broadcast(ids), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        named = written(named, "search-ranks")
        out = named if out is None else out.union(named)
    assert out is not None
    return out


def search_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The result of the query."""
    return search(docs, items)
