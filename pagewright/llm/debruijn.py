"""Removal of long repeated spans with a compacted De Bruijn graph of tokens.

A word goes if a window of ``window`` consecutive words that covers it also starts in a document
with a smaller id. Windows are the edges of a De Bruijn graph whose nodes are the runs of
``window - 1`` words between them; a path of the graph is a longer text.

1. *Edges.* Neighbouring windows that share their anchor (the run of ``window // 4`` words with the
   smallest hash) form one row, which is a path already. Anchors that all stand in documents of
   one id hold no repeated edge. A row that equals one of a smaller id is a copy in full. Where an
   anchor has different rows, the first document of each also gives its windows as edges of their
   own, since one row may share a part with another. No window is left out of this.
2. *Compaction.* An edge or path that always goes on into the same next one, which occurs as
   often, has a nonbranching node behind it: both become one path. Joins find these links, and
   further joins double their reach until every path has its whole length. All copies of a path
   are complete, so each is known by the place of its first edge.
3. *Source coordinates.* A path's source is the document with its smallest id. Every copy and the
   source itself are read at their places, and strong digests of their words are compared.

Hashes only propose. Should a digest ever differ, all is done again with stronger word hashes.

Defined cases: a null text has no words; texts under ``window`` words are kept whole; a document
with a null id neither loses words nor makes others lose them; documents with the same id do not
remove from each other, nor does a document from itself; repeated rows each get a row; empty
tables give empty results; columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.frames import id_type, map_texts, raw_bytes, written
from pagewright.llm.suffixes import _smallest_of_runs as smallest_of_runs
from pagewright.llm.words import PLAIN_BYTES, Prefix, Words, mixed
from pagewright.operators.skew import heavy_keys, lookup_join

WINDOW = 50
#: Word hashes that are tried before giving up; the first are quick, the others strong.
TRIES = 3
#: Doublings that reach the end of any path.
MOST_ROUNDS = 64
_U64 = np.uint64
_LOW, _HIGH = _U64(0xFFFFFFFF), _U64(0xFFFFFFFF00000000)
_BITS = 12


class Edges:
    """The edges of one text, and the rows of edges that share an anchor.

    ``edge`` and ``core`` are the hashes of each window and of its anchor; row ``r`` has the
    windows ``first[r]`` to ``first[r] + count[r] - 1``, with the anchor ``offset[r]`` words in.
    """

    def __init__(self, raw: bytes, window: int, seed: int) -> None:
        self.words = Words(raw, PLAIN_BYTES)
        anchor = max(1, window // 4)
        if len(self.words) < window:
            none = np.zeros(0, np.int64)
            self.first = self.count = self.offset = none
            self.edge = self.core = none.view(_U64)
            return
        self._hashes = Prefix(self._word_hashes(seed))
        self._window = window
        self.edge = self._hashes.every(window)
        anchors = self._hashes.every(anchor)
        keys = (anchors & _HIGH) | np.arange(len(anchors), dtype=_U64)
        places = (smallest_of_runs(keys, window - anchor + 1) & _LOW).astype(np.int64)
        self.core = anchors[places]
        self.first = np.concatenate([[0], np.flatnonzero(np.diff(places)) + 1])
        self.count = np.diff(np.append(self.first, len(places)))
        self.offset = places[self.first] - self.first

    def _word_hashes(self, seed: int) -> np.ndarray:
        words = self.words
        if not seed:
            return words.runs(1)
        return np.array([xxhash.xxh3_64_intdigest(words.bytes_of(k, 1), seed) for k in range(len(words))], _U64)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(core, hash of all its words and its anchor's place, packed place) of each row."""
        if not len(self.first):
            return self.core, self.core, self.first
        ends = self.first + self.count - 1 + self._window
        whole = mixed(self._hashes.ranges(self.first, ends) + self.offset.astype(_U64))
        return self.core[self.first], whole, (self.first << 2 * _BITS) | (self.count << _BITS) | self.offset

    def single(self, places: np.ndarray) -> list[np.ndarray]:
        """Each edge of the wanted rows: core, edge, next core, next edge, first, and whether the next one is wanted too."""
        wanted = np.zeros(len(self.first), bool)
        wanted[np.searchsorted(self.first, places >> 2 * _BITS)] = True
        each = np.append(np.repeat(wanted, self.count), False)
        first = np.flatnonzero(each)
        after = np.minimum(first + 1, len(self.edge) - 1)
        return [self.core[first], self.edge[first], self.core[after], self.edge[after], first, each[first + 1]]


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == _U64 else values, pa.int64())


def _texts(docs: DataFrame, id_col: str, text_col: str, row: Column | None = None) -> DataFrame:
    """id, text, ``twin`` (tells rows of one id with different texts apart) and the columns to keep."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    more = [] if row is None else [row.alias("row")]
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("twin"), *more)


def _repeated_rows(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """Rows whose anchor also stands in a document of another id: id, twin, core, whole, place, path, split.

    ``path``: an equal row stands in a document of another id. ``split``: the anchor has other
    rows too, and this is one of the first document with such a row.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [Edges(raw, window, seed).rows() for raw in raw_bytes(batch.column("text"))]
            at = pa.array(np.repeat(np.arange(len(parts)), [len(p[2]) for p in parts]))
            columns = [_long(np.concatenate(p)) for p in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("twin").take(at), *columns], ["id", "twin", "core", "whole", "place"]
            )

    known = texts.where("id is not null")
    kind = id_type(texts, "id")
    inputs = {c: F.col(c) for c in ("id", "twin", "text")}
    named = written(map_texts(known, inputs, f"id {kind}, twin bigint, core bigint, whole bigint, place bigint", rows), "graph-rows")
    anchors = named.groupBy("core").agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), (F.min("whole") == F.max("whole")).alias("equal")
    )
    anchors = written(anchors.where("low < high").select("core", "n", "equal"), "graph-anchors")
    hot = heavy_keys(anchors, "core", "n")
    met = written(lookup_join(named, anchors.drop("n"), ["core"], hot).where("equal is not null"), "graph-repeated")
    # An anchor of a common passage has as many rows as the passage has surroundings, so rows, not anchors, are hot here.
    unlike, row = met.where("not equal"), ["core", "whole"]
    wholes = written(unlike.groupBy(*row).agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")), "graph-wholes")
    told = lookup_join(unlike, wholes.drop("n"), row, heavy_keys(wholes, row, "n"))
    columns = ["id", "twin", "core", "whole", "place"]
    some = told.select(*columns, (F.col("low") < F.col("high")).alias("path"), (F.col("id") == F.col("low")).alias("split"))
    return some.union(met.where("equal").select(*columns, F.lit(True), F.lit(False)))


def _pieces(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """Occurrences of paths and edges: id, twin, core, edge (their key), next_core, next_edge, first, size."""
    repeated = written(_repeated_rows(texts, window, seed), "graph-told")
    names = ["core", "edge", "next_core", "next_edge", "first"]

    # Dealt out by document, where repeated rows of the table are dropped and neighbours meet.
    by_place = Window.partitionBy("id", "twin").orderBy("place")
    paths = repeated.where("path").repartition("id", "twin").dropDuplicates(["id", "twin", "place"])
    first, count = F.shiftright("place", 2 * _BITS), F.shiftright("place", _BITS).bitwiseAND((1 << _BITS) - 1)
    follows = F.lead(first).over(by_place) == first + count
    paths = paths.select(
        "id", "twin", "core", F.col("whole").alias("edge"), *(F.when(follows, F.lead(c).over(by_place)).alias(n) for c, n in (("core", "next_core"), ("whole", "next_edge"))), first.alias("first"), count.alias("size")
    )

    wanted = repeated.where("split").groupBy("id", "twin").agg(F.collect_set("place").alias("places"))
    same = (texts["id"] == wanted["id"]) & (texts["twin"] == wanted["twin"])
    joined = texts.join(wanted, same).select(texts["id"], texts["twin"], "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = zip(raw_bytes(batch.column("text")), batch.column("places").to_pylist(), strict=True)
            parts = [Edges(raw, window, seed).single(np.array(places, np.int64)) for raw, places in told]
            at = pa.array(np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]))
            columns = [np.concatenate(p) for p in zip(*parts, strict=True)]
            goes_on = pa.array(columns.pop())
            arrays = [_long(c) for c in columns]
            for k in (2, 3):
                arrays[k] = pc.if_else(goes_on, arrays[k], pa.scalar(None, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("twin").take(at), *arrays], ["id", "twin", *names])

    schema = f"id {id_type(texts, 'id')}, twin bigint, " + ", ".join(f"{n} bigint" for n in names)
    edges = map_texts(joined, {c: F.col(c) for c in ("id", "twin", "text", "places")}, schema, cut)
    return written(paths.union(edges.withColumn("size", F.lit(1).cast("bigint"))), "graph-pieces")


def compacted(graph: DataFrame) -> DataFrame:
    """Whole paths of a graph: the key (core, edge) of the first piece, its source, n, and all edges in ``size``.

    ``graph`` holds each different piece once: core, edge, source, n (occurrences), size, next_core
    and next_edge (null unless every occurrence goes on into that piece). A link leads to the next
    piece if that occurs as often.
    """
    after = graph.select(F.col("core").alias("next_core"), F.col("edge").alias("next_edge"), "n")
    met = graph.join(after, ["next_core", "next_edge", "n"], "left_semi")
    links = written(met.select("core", "edge", F.col("next_core").alias("to_core"), F.col("next_edge").alias("to_edge")), "graph-links")
    heads = graph.join(links.select(F.col("to_core").alias("core"), F.col("to_edge").alias("edge")), ["core", "edge"], "left_anti")
    # Of each linked piece: the edges from it to the piece it points to, which is not counted;
    # and of each piece whose end is known, the edges up to there. A round doubles the reach.
    reach = written(graph.select("core", "edge", "size").join(links, ["core", "edge"]), "graph-reach")
    known = graph.join(links, ["core", "edge"], "left_anti").select("core", "edge", "size")
    to, far = ["to_core", "to_edge"], ["far_core", "far_edge"]
    for _ in range(MOST_ROUNDS):
        if reach.isEmpty():
            break
        ahead = reach.toDF(*to, "more", *far)
        step = written(reach.join(ahead, to, "left"), "graph-reach")
        ends = known.toDF(*to, "rest")
        over = step.where("far_core is null").join(ends, to).select("core", "edge", (F.col("size") + F.col("rest")).alias("size"))
        known = known.union(written(over, "graph-known"))
        jumped = step.where("far_core is not null")
        reach = jumped.select("core", "edge", (F.col("size") + F.col("more")).alias("size"), *(F.col(f).alias(t) for f, t in zip(far, to, strict=True)))
    else:
        raise ArithmeticError("a path without an end: different texts have equal hashes")
    whole = known.withColumnRenamed("size", "whole")
    return heads.join(whole, ["core", "edge"]).select("core", "edge", "source", "n", F.col("whole").alias("size"))


def _paths(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """Copies and sources of all repeated paths: id, twin, core, edge, start, end (in words), source."""
    pieces = _pieces(texts, window, seed)
    each = pieces.groupBy("core", "edge").agg(
        F.min("id").alias("source"),
        F.max("id").alias("last"),
        F.count("*").alias("n"),
        F.count("next_edge").alias("followed"),
        *(f("next_" + c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("core", "edge")),
        F.min("size").alias("size"),
    )
    always = (F.col("followed") == F.col("n")) & (F.col("min_core") == F.col("max_core")) & (F.col("min_edge") == F.col("max_edge"))
    graph = each.where("source < last").select(
        "core", "edge", "source", "n", "size", *(F.when(always, F.col(f"min_{c}")).alias(f"next_{c}") for c in ("core", "edge"))
    )
    paths = written(compacted(written(graph, "graph")), "graph-paths")
    hot = heavy_keys(paths, ["core", "edge"], "n")
    starts = pieces.select("id", "twin", "core", "edge", "first")
    met = lookup_join(starts, paths.select("core", "edge", "source", "size"), ["core", "edge"], hot).where("source is not null")
    return met.select(
        "id", "twin", "core", "edge", F.col("first").alias("start"), (F.col("first") + F.col("size") - 1 + window).alias("end"), "source"
    )


def _joined_spans(found: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for span in sorted(found, key=lambda s: s["start"]):
        if out and span["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], span["end"]))
        else:
            out.append((span["start"], span["end"]))
    return out


def _kept_words(words: Words, gone: list[tuple[int, int]]) -> bytes:
    """The words outside ``gone``, joined by single spaces."""
    kept = np.ones(len(words.data), bool)
    for a, b in gone:
        kept[words.starts[a] : words.ends[b - 1] + 1] = False
    return words.data[kept].tobytes().removesuffix(b" ")


def remove_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    with_text: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """Per document: id, n_words, removed (start, end in words), kept_sha256, kept (null unless ``with_text``).

    ``copies`` tells of each repeated path the words it covers and the id of its source, and
    ``row`` holds the columns of ``keep``.
    """
    if not 1 <= window < 1 << _BITS:
        raise ValueError(f"a window has 1 to {(1 << _BITS) - 1} words")
    for seed in range(TRIES):
        found = _removed(docs, id_col, text_col, window, with_text, keep, seed)
        proofs = found.select(F.explode("proofs").alias("p")).groupBy("p.core", "p.edge")
        told = proofs.agg(*(f(f"p.{c}").alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("one", "two")))
        if told.where("min_one <> max_one or min_two <> max_two").isEmpty():
            return found.drop("proofs")
    raise ArithmeticError("different texts have equal hashes, whatever the hash")


def _removed(docs: DataFrame, id_col: str, text_col: str, window: int, with_text: bool, keep: list[str] | None, seed: int) -> DataFrame:
    row = F.struct(*(keep or [id_col]))
    kind = docs.select(row.alias("row")).schema["row"].dataType.simpleString()
    id_kind = id_type(docs, id_col)
    paths = _paths(_texts(docs, id_col, text_col), window, seed)
    by_text = paths.groupBy("id", "twin").agg(F.collect_set(F.struct("core", "edge", "start", "end", "source")).alias("paths"))
    texts = _texts(docs, id_col, text_col, row)
    same = (texts["id"] == by_text["id"]) & (texts["twin"] == by_text["twin"])
    marked = texts.join(by_text, same, "left").select(texts["id"], "text", "row", "paths")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    proof = pa.struct([(n, pa.int64()) for n in ("core", "edge", "one", "two")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, removed, copies, proofs, digests, kept = [], [], [], [], [], []
            columns = (batch.column("id").to_pylist(), raw_bytes(batch.column("text")), batch.column("paths").to_pylist())
            for own, raw, paths in zip(*columns, strict=True):
                words = Words(raw, PLAIN_BYTES)
                theirs = [p for p in paths or () if p["source"] < own]
                gone = _joined_spans(theirs)
                read = []
                for p in paths or ():
                    text = words.data[words.starts[p["start"]] : words.ends[p["end"] - 1]].tobytes()
                    one, two = np.frombuffer(xxhash.xxh3_128_digest(text), np.int64).tolist()
                    read.append({"core": p["core"], "edge": p["edge"], "one": one, "two": two})
                rest = _kept_words(words, gone)
                n_words.append(len(words))
                removed.append([{"start": a, "end": b} for a, b in gone])
                copies.append([{"start": p["start"], "end": p["end"], "source": p["source"]} for p in sorted(theirs, key=lambda p: p["start"])])
                proofs.append(read)
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("row"),
                    pa.array(n_words, pa.int64()),
                    pa.array(removed, pa.list_(span)),
                    pa.array(copies, pa.list_(pa.struct([*span, ("source", batch.column("id").type)]))),
                    pa.array(proofs, pa.list_(proof)),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.string()),
                ],
                ["id", "row", "n_words", "removed", "copies", "proofs", "kept_sha256", "kept"],
            )

    schema = (
        f"id {id_kind}, row {kind}, n_words bigint, removed array<struct<start:bigint,end:bigint>>, "
        f"copies array<struct<start:bigint,end:bigint,source:{id_kind}>>, "
        "proofs array<struct<core:bigint,edge:bigint,one:bigint,two:bigint>>, kept_sha256 string, kept string"
    )
    out = map_texts(marked, {c: F.col(c) for c in ("id", "row", "text", "paths")}, schema, cut)
    return written(out.withColumnRenamed("id", id_col), "graph-removed")


def span_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The result of the query: counts and the digest of what is kept."""
    found = remove_spans(docs, id_col, text_col, window, with_text=False)
    n_removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda total, s: total + (s["end"] - s["start"]))
    return found.select(F.col(id_col).alias("doc_id"), "n_words", n_removed.alias("n_removed"), "kept_sha256")
