"""Greedy packing of ordered segments into chunks under a budget, inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions.binding import let

# Segments folded per inner pass; keeps the arrays that the fold copies short.
FOLD_BLOCK = 512


def pack_starts(lengths: Column, budget: int) -> Column:
    """Positions (from 0) of the segments that open a chunk.

    A segment joins the current chunk while the sum stays below ``budget``, else it opens
    the next one; a segment over the budget stays whole. The fold is nested (blocks of
    segments, then segments), so its cost grows with the row's length and not its square.
    """
    no_starts = F.array().cast("array<int>")

    def state(total: Column, position: Column, starts: Column) -> Column:
        return F.struct(total.alias("total"), position.alias("position"), starts.alias("starts"))

    def step(current: Column, length: Column) -> Column:
        position = current["position"]
        total = current["total"] + length
        opens = (total >= budget) | (position == 0)
        return state(
            F.when(opens, length.cast("bigint")).otherwise(total),
            position + 1,
            F.when(opens, F.concat(current["starts"], F.array(position))).otherwise(
                current["starts"]
            ),
        )

    def fold_block(outer: Column, block: Column) -> Column:
        opened = F.aggregate(block, state(outer["total"], outer["position"], no_starts), step)
        return let(
            opened,
            lambda done: state(
                done["total"], done["position"], F.concat(outer["starts"], F.array(done["starts"]))
            ),
        )

    def fold(all_lengths: Column) -> Column:
        n_blocks = F.ceil(F.size(all_lengths) / FOLD_BLOCK).cast("int")
        numbers = F.when(n_blocks > 0, F.sequence(F.lit(1), n_blocks)).otherwise(no_starts)
        blocks = F.transform(
            numbers, lambda b: F.slice(all_lengths, (b - 1) * FOLD_BLOCK + 1, FOLD_BLOCK)
        )
        none = F.array().cast("array<array<int>>")
        nothing = state(F.lit(0).cast("bigint"), F.lit(0), none)
        return F.aggregate(blocks, nothing, fold_block, lambda done: F.flatten(done["starts"]))

    return let(lengths, fold)


def pack_segments(segments: Column, budget: int, separator: str = "\n") -> Column:
    """Array of (text, length, n_segments) chunks of an array of strings.

    ``length`` counts the characters of the segments only; ``text`` joins them with
    ``separator``.
    """

    def chunk(all_segments: Column, starts: Column, start: Column, nth: Column) -> Column:
        end = F.coalesce(F.get(starts, nth + 1), F.size(all_segments))
        text = F.array_join(F.slice(all_segments, start + 1, end - start), separator)
        separators = (end - start - 1) * len(separator)
        return let(
            text,
            lambda joined: F.struct(
                joined.alias("text"),
                (F.length(joined) - separators).cast("bigint").alias("length"),
                (end - start).alias("n_segments"),
            ),
        )

    return let(
        segments,
        lambda all_segments: let(
            pack_starts(F.transform(all_segments, lambda s: F.length(s)), budget),
            lambda starts: F.transform(
                starts, lambda start, nth: chunk(all_segments, starts, start, nth)
            ),
        ),
    )
