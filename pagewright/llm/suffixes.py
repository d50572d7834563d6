"""Removal of repeated byte strings with a distributed suffix array.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the
same document or another; strings never cross documents and are judged on the input.

Suffixes are compared by tokens: 64-bit names of fixed byte ranges, so that equal leading
tokens mean equal leading bytes. ``sorted_neighbours`` is the suffix array: sampled splitters
range-partition the suffixes by their leading tokens, every bucket sorts its own by multikey
quicksort, common prefixes are taken between neighbours, and across bucket borders from each
bucket's first and last suffix. Splitters break ties by document and place, so a string that
a third of the documents hold is cut over many buckets and no bucket grows with it.

One suffix per byte would be a shuffle of many times the text, so strings are taken in runs of
neighbouring starts, in three rounds of the same kind. A run has two tokens: its core, a range
that each of its strings covers, and its whole. Runs with equal wholes repeat in full; a run
whose core stands once holds no repeat; runs with equal cores but different wholes are cut into
smaller runs for the next round, one or two representatives for each different whole.

1. Every string is named by the smallest hash of its inner ranges of half its length (the
   leftmost on a tie): equal strings have equal names at equal places. The strings that share a
   name form a run of about half the length / 2 starts; the name is the core.
2. A run is cut into blocks of ``length / 25`` starts, counted from the name's place.
3. Blocks are cut into single strings, with their two halves as tokens.

No round loses a string that repeats, and the first looks at every string of every document.

Defined cases: a null text is empty; texts under ``length`` bytes are kept whole; repeated
rows repeat each other's text; null ids are ids like any other; empty tables give empty
results; columns other than id and text are not looked at. Kept bytes that are no longer
whole characters are dropped where a text is asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.frames import id_type, map_texts, raw_bytes, written
from pagewright.llm.words import Prefix

LENGTH = 400
#: Below so many suffixes a range is sorted at once.
SMALL_RANGE = 2048

_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def multikey_quicksort(tokens: list[np.ndarray]) -> np.ndarray:
    """The order of suffixes by their tokens: three-way partitions, equal parts by the next token."""
    order = np.arange(len(tokens[0]))
    todo = [(0, len(order), 0)]
    while todo:
        low, high, depth = todo.pop()
        part = order[low:high]
        if high - low <= SMALL_RANGE:
            order[low:high] = part[np.lexsort([t[part] for t in tokens[:depth:-1]] + [tokens[depth][part]])]
            continue
        keys = tokens[depth][part]
        pivot = np.sort(keys[:: max(1, len(keys) // 63)])[32]
        below, equal, above = part[keys < pivot], part[keys == pivot], part[keys > pivot]
        first, second = low + len(below), low + len(below) + len(equal)
        order[low:first], order[first:second], order[second:high] = below, equal, above
        todo += [(low, first, depth), (second, high, depth)]
        if depth + 1 < len(tokens):
            todo.append((first, second, depth + 1))
    return order


def _common(tokens: list[np.ndarray]) -> np.ndarray:
    """Leading tokens that each suffix shares with the one before it."""
    same = np.ones(len(tokens[0]) - 1, bool)
    shared = np.zeros(len(same), np.int32)
    for token in tokens:
        same &= token[1:] == token[:-1]
        shared += same
    return shared


def sorted_neighbours(suffixes: DataFrame, tokens: list[str], least: int, label: str) -> DataFrame:
    """Suffixes that share ``least`` leading tokens with a neighbour in sorted order.

    Adds ``before`` and ``after``: how many tokens are shared with either neighbour. The result
    is a written table.
    """
    columns = list(suffixes.columns)
    payload = [c for c in columns if c not in tokens]
    ranged = suffixes.repartitionByRange(*tokens, *payload)
    kinds = ", ".join(f"`{c}` {t}" for c, t in suffixes.dtypes)
    schema = f"{kinds}, bucket int, border int, before int, after int"

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [batch for batch in batches if batch.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        keys = [table.column(t).to_numpy() for t in tokens]
        order = multikey_quicksort(keys)
        shared = _common([k[order] for k in keys])
        before, after = np.zeros(len(order), np.int32), np.zeros(len(order), np.int32)
        before[1:], after[:-1] = shared, shared
        border = np.zeros(len(order), np.int32)
        border[0] += 1
        border[-1] += 2
        kept = np.flatnonzero((np.maximum(before, after) >= least) | (border > 0))
        out = table.take(pa.array(order[kept]))
        for name in tokens:  # only borders still need them
            at = out.schema.get_field_index(name)
            out = out.set_column(at, name, pc.if_else(pa.array(border[kept] > 0), out.column(at), pa.scalar(None, pa.int64())))
        for name, values in (("border", border), ("before", before), ("after", after)):
            out = out.append_column(name, pa.array(values[kept]))
        yield from out.select([*columns, "bucket", "border", "before", "after"]).to_batches(max_chunksize=20000)

    inputs = {c: F.col(c) for c in columns} | {"bucket": F.spark_partition_id()}
    found = written(map_texts(ranged, inputs, schema, bucket), label)

    # At most two rows of each bucket come to the driver.
    edges = found.where("border > 0").select(*tokens, "bucket", "border").orderBy("bucket").collect()
    last, shared_before, shared_after = None, {}, {}
    for row in sorted(edges, key=lambda r: (r.bucket, r.border)):
        if row.border & 1 and last is not None:
            n = 0
            while n < len(tokens) and row[n] == last[n]:
                n += 1
            shared_before[row.bucket], shared_after[last.bucket] = n, n
        if row.border & 2:
            last = row
    numbers = sorted({row.bucket for row in edges})
    fixed = suffixes.sparkSession.createDataFrame(
        [(b, shared_before.get(b, 0), shared_after.get(b, 0)) for b in numbers], "bucket int, left_shared int, right_shared int"
    )
    joined = found.join(F.broadcast(fixed), "bucket")
    before = F.when(F.col("border").bitwiseAND(1) > 0, F.col("left_shared")).otherwise(F.col("before"))
    after = F.when(F.col("border").bitwiseAND(2) > 0, F.col("right_shared")).otherwise(F.col("after"))
    return joined.select(*payload, before.alias("before"), after.alias("after")).where(F.greatest("before", "after") >= least)


def _smallest_of_runs(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive keys."""
    count = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def named_runs(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(core, whole, packed place) of the runs of strings of one text."""
    if len(raw) < length:
        none = np.zeros(0, np.int64)
        return none, none, none
    half = length // 2
    hashes = Prefix(np.frombuffer(raw, np.uint8)).every(half)
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    places = (_smallest_of_runs(keys, length - half + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(places)) + 1])
    counts = np.diff(np.append(first, len(places)))
    places = places[first]
    whole = [
        xxhash.xxh3_64_intdigest(raw[a : a + n + length - 1], seed=p - a)
        for a, n, p in zip(first.tolist(), counts.tolist(), places.tolist(), strict=True)
    ]
    packed = (first << 32) | (counts << 16) | (places - first)
    return hashes[places].view(np.int64), np.array(whole, np.uint64).view(np.int64), packed


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _columns(docs: DataFrame, id_col: str, text_col: str, row: Column | None = None) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    more = [] if row is None else [row.alias("row")]
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("twin"), *more)


def _emit(names: list[str], ids: pa.Array, twins: pa.Array, rows: list[int], columns: list[tuple[list, pa.DataType]]) -> pa.RecordBatch:
    at = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays([ids.take(at), twins.take(at), *(pa.array(v, t) for v, t in columns)], ["id", "twin", *names])


def _same(left: DataFrame, right: DataFrame, *more: str) -> Column:
    same = left["id"].eqNullSafe(right["id"]) & (left["twin"] == right["twin"])
    for name in more:
        same &= left[name] == right[name]
    return same


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Byte ranges (id, twin, start, end) whose every string of ``length`` bytes repeats.

    ``twin`` is a hash of the text, so that rows that share an id but not a text stay apart.
    """
    kind = id_type(docs, id_col)
    texts = _columns(docs, id_col, text_col)
    block = max(1, length // 25)
    key = f"id {kind}, twin bigint"
    full = F.least(F.lit(2), F.greatest("before", "after")) == 2
    edge = (F.col("before") == 1) | (F.col("after") == 1)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [named_runs(raw, length) for raw in raw_bytes(batch.column("text"))]
            rows = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            columns = [(np.concatenate(p), pa.int64()) for p in zip(*parts, strict=True)]
            yield _emit(["core", "whole", "place"], batch.column("id"), batch.column("twin"), rows, columns)

    inputs = {c: F.col(c) for c in ("id", "twin", "text")}
    named = map_texts(texts, inputs, f"{key}, core bigint, whole bigint, place bigint", runs)
    first = F.shiftright("place", 32)
    found = sorted_neighbours(named, ["core", "whole"], 1, "suffix-runs").withColumns(
        {"first": first, "count": F.shiftright("place", 16).bitwiseAND(0xFFFF), "place": F.col("place").bitwiseAND(0xFFFF)}
    )
    end = F.col("first") + F.col("count") - 1 + length
    ranges = found.where(full).select("id", "twin", F.col("first").cast("int").alias("start"), end.cast("int").alias("end"))

    # The runs to cut, each with its own bytes: later rounds do not go back to the texts.
    wanted = found.where(edge).groupBy("id", "twin").agg(F.collect_set(F.struct("first", "count", "place")).alias("runs"))
    at_edges = texts.join(wanted, _same(texts, wanted)).select(texts["id"], texts["twin"], "text", "runs")

    def with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_and_runs = zip(raw_bytes(batch.column("text")), batch.column("runs").to_pylist(), strict=True)
            for k, (raw, cut) in enumerate(texts_and_runs):
                columns = [
                    ([r["first"] for r in cut], pa.int64()),
                    ([r["count"] for r in cut], pa.int64()),
                    ([r["place"] for r in cut], pa.int64()),
                    ([raw[r["first"] : r["first"] + r["count"] - 1 + length] for r in cut], pa.binary()),
                ]
                yield _emit(["first", "count", "place", "bytes"], batch.column("id"), batch.column("twin"), [k] * len(cut), columns)

    inputs = {c: F.col(c) for c in ("id", "twin", "text", "runs")}
    schema = f"{key}, first bigint, count bigint, place bigint, bytes binary"
    edges = written(map_texts(at_edges, inputs, schema, with_bytes), "suffix-edges")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, core, whole, first, start, count = [], [], [], [], [], []
            numbers = zip(*(batch.column(c).to_pylist() for c in ("first", "count", "place", "bytes")), strict=True)
            for k, (run, n, place, raw) in enumerate(numbers):
                for b in range((place - n + 1) // block, place // block + 1):
                    most, least = place - b * block, place - b * block - block + 1
                    a, z = max(0, least), min(n - 1, most)
                    rows.append(k)
                    core.append(_signed(xxhash.xxh3_64_intdigest(raw[most : least + length], seed=b % (1 << 32))))
                    whole.append(_signed(xxhash.xxh3_64_intdigest(raw[a : z + length], seed=(a - least) * block + most - z)))
                    first.append(run)
                    start.append(run + a)
                    count.append(z - a + 1)
            columns = [(v, pa.int64()) for v in (core, whole, first, start, count)]
            yield _emit(["core", "whole", "first", "start", "count"], batch.column("id"), batch.column("twin"), rows, columns)

    inputs = {c: F.col(c) for c in ("id", "twin", "first", "count", "place", "bytes")}
    schema = f"{key}, core bigint, whole bigint, first bigint, start bigint, count bigint"
    found = sorted_neighbours(map_texts(edges, inputs, schema, blocks), ["core", "whole"], 1, "suffix-blocks")
    end = F.col("start") + F.col("count") - 1 + length
    ranges = ranges.union(found.where(full).select("id", "twin", F.col("start").cast("int"), end.cast("int")))
    wanted = found.where(edge).groupBy("id", "twin", "first").agg(F.collect_set(F.struct("start", "count")).alias("blocks"))
    at_edges = edges.join(wanted, _same(edges, wanted, "first")).select(edges["id"], edges["twin"], edges["first"], "bytes", "blocks")

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = length // 2
        for batch in batches:
            rows, left, right, start = [], [], [], []
            numbers = zip(*(batch.column(c).to_pylist() for c in ("first", "bytes", "blocks")), strict=True)
            for k, (run, raw, cut) in enumerate(numbers):
                for at in (b["start"] + j for b in cut for j in range(b["count"])):
                    rows.append(k)
                    left.append(_signed(xxhash.xxh3_64_intdigest(raw[at - run : at - run + half])))
                    right.append(_signed(xxhash.xxh3_64_intdigest(raw[at - run + half : at - run + length])))
                    start.append(at)
            columns = [(left, pa.int64()), (right, pa.int64()), (start, pa.int32())]
            yield _emit(["core", "whole", "start"], batch.column("id"), batch.column("twin"), rows, columns)

    inputs = {c: F.col(c) for c in ("id", "twin", "first", "bytes", "blocks")}
    single = map_texts(at_edges, inputs, f"{key}, core bigint, whole bigint, start int", strings)
    found = sorted_neighbours(single, ["core", "whole"], 2, "suffix-strings")
    return ranges.union(found.select("id", "twin", "start", F.col("start") + length))


def _merged(ranges: list[dict] | None) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for r in sorted(ranges or (), key=lambda r: r["start"]):
        if merged and r["start"] <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], r["end"]))
        else:
            merged.append((r["start"], r["end"]))
    return merged


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    with_text: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """Per document: id, n_bytes, removed (byte ranges), kept_sha256, kept (text; null unless ``with_text``).

    ``row`` holds the columns of ``keep``.
    """
    row = F.struct(*(keep or [id_col]))
    kind = docs.select(row.alias("row")).schema["row"].dataType.simpleString()
    texts = _columns(docs, id_col, text_col, row)
    ranges = repeated_ranges(docs, id_col, text_col, length)
    marks = ranges.groupBy("id", "twin").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    marked = texts.join(marks, _same(texts, marks), "left").select(texts["id"], "text", "row", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, digests, kept = [], [], [], []
            for raw, found in zip(raw_bytes(batch.column("text")), batch.column("ranges").to_pylist(), strict=True):
                gone = _merged(found)
                edges = [0, *(x for pair in gone for x in pair), len(raw)]
                rest = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                sizes.append(len(raw))
                removed.append([{"start": a, "end": b} for a, b in gone])
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode("utf-8", "ignore") if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("row"),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, _RANGES),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.string()),
                ],
                ["id", "row", "n_bytes", "removed", "kept_sha256", "kept"],
            )

    schema = f"id {id_type(docs, id_col)}, row {kind}, n_bytes bigint, removed array<struct<start:int,end:int>>, kept_sha256 string, kept string"
    out = map_texts(marked, {c: F.col(c) for c in ("id", "row", "text", "ranges")}, schema, cut)
    return out.withColumnRenamed("id", id_col)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated strings cut out of the texts; documents left blank by that go."""
    # The text comes back, so it is not carried along; a null text comes back as null.
    others = [c for c in docs.columns if c != text_col]
    blank = docs.withColumn("__null", F.col(text_col).isNull()) if "__null" not in docs.columns else docs
    found = remove_repeats(blank, id_col, text_col, length, keep=[*others, "__null"])
    cut = F.size("removed") > 0
    values = {c: F.col(f"row.`{c}`") for c in others}
    values = {c: values.get(c, F.when(~F.col("row.__null"), F.col("kept"))) for c in docs.columns}
    if "n_chars" in values:
        values["n_chars"] = F.when(cut, F.length("kept").cast(id_type(docs, "n_chars"))).otherwise(values["n_chars"])
    return found.where(~cut | (F.trim(F.col("kept"), F.lit(" \t\r\n")) != "")).select(*(v.alias(c) for c, v in values.items()))


def _removed_bytes(ranges: str) -> Column:
    return F.aggregate(ranges, F.lit(0).cast("bigint"), lambda total, r: total + (r["end"] - r["start"]))


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The result of the query: counts and the digest of what is kept."""
    found = remove_repeats(docs, id_col, text_col, length, with_text=False)
    return found.select(
        F.col(id_col).alias("doc_id"),
        "n_bytes",
        _removed_bytes("removed").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        "kept_sha256",
    )
