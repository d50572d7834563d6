"""Greedy packing of segments that are rows, however many tasks hold the segments of one key.

A segment joins the open chunk while the sum of lengths stays below the budget, else it opens the
next chunk; one over the budget stays whole. That reads like a walk along the key, so the segments
of a key are cut into blocks of positions, and each block is turned into a function: from the
length of the chunk open before it, to the number of chunks it opens and the length it leaves
open. The function is a short list of steps, because the first chunk that a block opens starts
within one budget of the block's start. Functions of neighbouring blocks compose to functions of
the same form, so a key's blocks are composed ``FAN`` at a time, level by level, and the open
lengths then come down the same levels. No task sees more than one block of segments, or ``FAN``
functions, whatever a key holds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.sinks.tables import materialize

#: Positions of a block, and blocks that are composed together, as powers of two.
BLOCK_BITS, FAN_BITS = 12, 10
#: Flips the sign bit, so that positions in order are unsigned numbers in order.
_SIGN = -(1 << 63)

_LISTS = ("reach", "opened", "left")


@dataclass
class Jumps:
    """What a run of segments does to the chunk that is open before it.

    Step ``i`` says what happens if the run's first chunk opens at its step's segment, which is
    so for open lengths of at least ``budget - reach[i]`` that reach no step before: it then opens
    ``opened[i]`` chunks and leaves the last one with length ``left[i]``. A length that reaches
    no step grows by ``total``, and no chunk is opened.
    """

    reach: np.ndarray
    opened: np.ndarray
    left: np.ndarray
    total: int

    def after(self, open_length: int, budget: int) -> tuple[int, int]:
        """(chunks opened, length left open) after the run."""
        step = int(np.searchsorted(self.reach, budget - open_length))
        if step == len(self.reach):
            return 0, open_length + self.total
        return int(self.opened[step]), int(self.left[step])


def next_openings(lengths: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths up to and with each segment, lengths before it, and where the chunk after the one it opens would open."""
    sums = np.cumsum(lengths)
    before = sums - lengths
    return sums, before, np.maximum(np.searchsorted(sums, before + budget), np.arange(1, len(lengths) + 1))


def block_jumps(lengths: np.ndarray, budget: int) -> Jumps:
    """The function of a block of segments."""
    sums, before, after = next_openings(lengths, budget)
    n, total = len(lengths), int(sums[-1])
    opened, left = [1] * n, (total - before).tolist()
    for k, nxt in zip(range(n - 1, -1, -1), after[::-1].tolist(), strict=True):
        if nxt < n:
            opened[k], left[k] = 1 + opened[nxt], left[nxt]
    heads = int(np.searchsorted(before, max(budget, 1)))
    return Jumps(sums[:heads], np.array(opened[:heads], np.int64), np.array(left[:heads], np.int64), total)


def composed(runs: list[Jumps], budget: int) -> Jumps:
    """The function of several runs, one after the other."""
    parts: list[Jumps] = []
    total = 0
    for k, run in enumerate(runs):
        if k and total >= max(budget, 1):
            break
        opened, left = run.opened.copy(), run.left.copy()
        for later in runs[k + 1 :]:
            steps = np.searchsorted(later.reach, budget - left)
            stays = steps == len(later.reach)
            more = np.append(later.opened, 0)[steps]
            left = np.where(stays, left + later.total, np.append(later.left, 0)[steps])
            opened = opened + more
        # A step of this run is reached only if no run before it opened a chunk.
        near = np.searchsorted(np.append(0, run.reach[:-1]) + total, max(budget, 1)) if len(run.reach) else 0
        parts.append(Jumps(run.reach[:near] + total, opened[:near], left[:near], run.total))
        total += run.total
    whole = sum(run.total for run in runs)
    return Jumps(*(np.concatenate([getattr(p, name) for p in parts]) for name in _LISTS), whole)


def _node(position: Column, bits: int) -> Column:
    """Block of a position; a null position comes before all others."""
    return F.shiftrightunsigned(F.coalesce(position.cast("bigint"), F.lit(_SIGN)).bitwiseXOR(F.lit(_SIGN)), bits)


def _table(key: pa.Array, rows: list[tuple[int, Jumps]]) -> pa.Table:
    lists = pa.list_(pa.int64())
    columns = [pa.array([node for node, _ in rows], pa.int64())]
    columns += [pa.array([getattr(j, name) for _, j in rows], lists) for name in _LISTS]
    columns.append(pa.array([j.total for _, j in rows], pa.int64()))
    return pa.Table.from_arrays([key.take(pa.array([0] * len(rows))), *columns], ["key", "node", *_LISTS, "total"])


def _jumps(table: pa.Table) -> list[Jumps]:
    """The functions of a table's rows, in order of their nodes."""
    lists = [[np.array(x, np.int64) for x in table.column(name).to_pylist()] for name in _LISTS]
    return [Jumps(*row) for row in zip(*lists, table.column("total").to_pylist(), strict=True)]


def pack_rows(
    segments: DataFrame, key: str, position: str, length: str, budget: int, block_bits: int = BLOCK_BITS, fan_bits: int = FAN_BITS
) -> DataFrame:
    """``segments`` with ``chunk_index``, the number of its chunk within its key, from 0.

    ``position`` is a whole number that orders the segments of a key; it may be sparse. Segments
    with equal positions go by length and then by the other columns, those without one come
    first, and a null length counts as 0. A block holds the segments of ``2 ** block_bits``
    positions. The functions and open lengths of each level are written to the shared folder.
    ``segments`` are read twice, so write them first if they are costly to make.
    """
    if budget < 0:
        raise ValueError("a budget is not negative")
    kind = segments.schema[key].dataType.simpleString()
    value = F.greatest(F.coalesce(F.col(length).cast("bigint"), F.lit(0)), F.lit(0))
    placed = segments.withColumns({"_node": _node(F.col(position), block_bits), "_length": value})
    jumps = f"key {kind}, node bigint, reach array<bigint>, opened array<bigint>, left array<bigint>, total bigint"

    def of_block(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("length", "ascending")])
        # Nulls sort last, but stand first.
        nulls = table.column("place").null_count
        lengths = np.roll(table.column("length").to_numpy(), nulls)
        return _table(table.column("key").combine_chunks(), [(table.column("node")[0].as_py(), block_jumps(lengths, budget))])

    small = placed.select(F.col(key).alias("key"), F.col("_node").alias("node"), F.col(position).cast("bigint").alias("place"), F.col("_length").alias("length"))
    levels = [materialize(small.groupBy("key", "node").applyInArrow(of_block, jumps), "packing-blocks")]

    def of_run(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("node")
        parent = ordered.column("node")[0].as_py() >> fan_bits
        return _table(ordered.column("key").combine_chunks(), [(parent, composed(_jumps(ordered), budget))])

    parent = F.shiftrightunsigned("node", fan_bits)
    while (levels[-1].groupBy("key").count().agg(F.max("count")).first()[0] or 0) > 1:
        grouped = levels[-1].groupBy("key", parent)
        levels.append(materialize(grouped.applyInArrow(of_run, jumps), "packing-runs"))

    # Before a key's first segment any length would be too much: it opens the first chunk.
    state = levels[-1].select("key", "node", F.lit(budget).cast("bigint").alias("open"), F.lit(0).cast("bigint").alias("chunks"))
    states = f"key {kind}, node bigint, open bigint, chunks bigint"

    def down(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("node")
        open_length, chunks = ordered.column("open")[0].as_py(), ordered.column("chunks")[0].as_py()
        rows: list[tuple[int, int]] = []
        for run in _jumps(ordered):
            rows.append((open_length, chunks))
            opened, open_length = run.after(open_length, budget)
            chunks += opened
        columns = [ordered.column("key"), ordered.column("node"), *(pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1))]
        return pa.Table.from_arrays(columns, ["key", "node", "open", "chunks"])

    for level in reversed(levels[:-1]):
        above = state.select(F.col("key").alias("_key"), F.col("node").alias("_parent"), "open", "chunks")
        met = level.join(above, level["key"].eqNullSafe(above["_key"]) & (parent == above["_parent"])).drop("_key", "_parent")
        state = materialize(met.groupBy("key", parent).applyInArrow(down, states), "packing-state")

    began = state.select(F.col("key").alias("_key"), F.col("node").alias("_block"), F.col("open").alias("_open"), F.col("chunks").alias("_chunks"))
    met = placed.join(began, placed[key].eqNullSafe(began["_key"]) & (placed["_node"] == began["_block"])).drop("_key", "_block")
    columns = segments.columns
    order = [(position, "ascending"), ("_length", "ascending"), *((c, "ascending") for c, t in segments.dtypes if c != position and not t.startswith(("array", "map", "struct")))]

    def assign(table: pa.Table) -> pa.Table:
        ordered = table.sort_by(order)
        nulls = ordered.column(position).null_count
        if nulls:
            ordered = pa.concat_tables([ordered.slice(ordered.num_rows - nulls), ordered.slice(0, ordered.num_rows - nulls)])
        sums, _, after = next_openings(ordered.column("_length").to_numpy(), budget)
        opens = np.zeros(ordered.num_rows, np.int64)
        at = int(np.searchsorted(sums, budget - ordered.column("_open")[0].as_py()))
        while at < len(opens):
            opens[at] = 1
            at = int(after[at])
        index = ordered.column("_chunks")[0].as_py() + np.cumsum(opens) - 1
        return ordered.select(columns).append_column("chunk_index", pa.array(index, pa.int64()))

    kinds = ", ".join(f"`{c}` {t}" for c, t in segments.dtypes)
    return met.groupBy(key, "_node").applyInArrow(assign, f"{kinds}, chunk_index bigint")


def pack_texts(segments: DataFrame, key: str, position: str, text: str, budget: int, separator: str = "\n", **blocks: int) -> DataFrame:
    """Texts in rows packed into chunks: (key, chunk_index, chunk, n_chars, n_segments).

    A chunk's texts are joined in order by ``separator``, which ``n_chars`` does not count. Null
    texts keep their place and add nothing.
    """
    sized = segments.select(key, position, text, F.length(text).alias("_n"))
    packed = pack_rows(sized, key, position, "_n", budget, **blocks)
    piece = F.struct(F.col(position).alias("p"), F.coalesce("_n", F.lit(0)).alias("n"), F.col(text).alias("t"))
    ordered = F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["t"])
    return packed.groupBy(key, "chunk_index").agg(
        F.array_join(ordered, separator).alias("chunk"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_chars"),
        F.count("*").alias("n_segments"),
    )


def pack_timed(segments: DataFrame, key: str, position: str, start: str, end: str, budget: int, **blocks: int) -> DataFrame:
    """Timed segments packed into chunks by their durations.

    Result: key, chunk_index, n_segments, length (sum of durations), start and end of the chunk.
    """
    sized = segments.select(key, position, start, end, (F.col(end) - F.col(start)).alias("_n"))
    packed = pack_rows(sized, key, position, "_n", budget, **blocks)
    return packed.groupBy(key, "chunk_index").agg(
        F.count("*").alias("n_segments"), F.sum("_n").alias("length"), F.min(start).alias(start), F.max(end).alias(end)
    )
