"""Batches of texts of like length, each padded to its own longest text."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators.embedding import EncoderFactory, hashed_words_encoder, made_encoder
from pagewright.sinks.tables import materialize

BATCH_ROWS = 32
#: Tokens that a model takes at most.
MODEL_TOKENS = 512
_PLACE_BITS = 33


def numbered(rows: DataFrame, order: list[str], output: str) -> DataFrame:
    """``rows`` with their numbers, from 0, in the order of all columns in ``order``.

    The rows are range-partitioned and sorted once and written to the shared folder; what is
    brought together after that is one count for each partition. Rows equal in ``order`` are
    numbered in any order.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("_at", _PLACE_BITS), F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    before, offsets = 0, []
    for row in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        offsets.append((row.part, before))
        before += row.n
    starts = F.broadcast(rows.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint"))
    return placed.join(starts, part == F.col("_part")).withColumn(output, F.col("_before") + place).drop("_at", "_part", "_before")


def length_batches(
    df: DataFrame, keys: list[str], text: str = "text", batch_rows: int = BATCH_ROWS, model_tokens: int = MODEL_TOKENS
) -> DataFrame:
    """Rows in order of their number of tokens, ``batch_rows`` to a batch: keys, text, tokens, n_tokens, batch.

    A text has its first ``model_tokens`` tokens. Texts with as many tokens go by their keys, so
    with unique keys the batches are the same on every run and every cluster. A null text has
    no tokens.
    """
    tokens = F.coalesce(X.tokens(F.col(text), first=model_tokens), F.array().cast("array<string>"))
    sized = df.select(*keys, text, tokens.alias("tokens")).withColumn("n_tokens", F.size("tokens"))
    ranked = numbered(sized, ["n_tokens", *keys], "_rank")
    return ranked.withColumn("batch", F.floor(F.col("_rank") / batch_rows)).drop("_rank")


def _padded(tokens: pa.Array, pad: str) -> tuple[pa.Array, int]:
    """The token lists, filled up to the longest of them; no row becomes a Python object."""
    offsets = tokens.offsets.to_numpy()
    lengths = np.diff(offsets)
    longest = int(lengths.max())
    values = pa.concat_arrays([tokens.values, pa.array([pad], tokens.type.value_type)])
    step = np.arange(longest)
    at = np.where(step < lengths[:, None], offsets[:-1, None] + step, len(values) - 1)
    ends = pa.array(np.arange(len(lengths) + 1, dtype=np.int32) * longest)
    return pa.ListArray.from_arrays(ends, values.take(pa.array(at.ravel()))), longest


def _per_batch(batches: DataFrame, keys: list[str], more: str, work: Callable[[pa.Table], pa.Table]) -> DataFrame:
    kinds = ", ".join(f"`{k}` {batches.schema[k].dataType.simpleString()}" for k in keys)
    return batches.groupBy("batch").applyInArrow(work, f"{kinds}, batch bigint, {more}")


def padded_batches(
    df: DataFrame,
    keys: list[str],
    text: str = "text",
    batch_rows: int = BATCH_ROWS,
    model_tokens: int = MODEL_TOKENS,
    pad: str = X.PAD_TOKEN,
) -> DataFrame:
    """Tokens padded to the longest text of their batch: keys, batch, n_tokens, padded_length, tokens.

    See ``length_batches`` for what a batch is. The places beyond ``n_tokens`` are what an
    encoder has to mask.
    """
    batches = length_batches(df, keys, text, batch_rows, model_tokens).drop(text)

    def fill(table: pa.Table) -> pa.Table:
        tokens, longest = _padded(table.column("tokens").combine_chunks(), pad)
        lengths = pa.array([longest] * table.num_rows, pa.int32())
        columns = [*(table.column(k) for k in keys), table.column("batch"), table.column("n_tokens"), lengths, tokens]
        return pa.Table.from_arrays(columns, [*keys, "batch", "n_tokens", "padded_length", "tokens"])

    return _per_batch(batches, keys, "n_tokens int, padded_length int, tokens array<string>", fill)


def embed_batches(
    df: DataFrame,
    keys: list[str],
    text: str = "text",
    output: str = "vector",
    batch_rows: int = BATCH_ROWS,
    model_tokens: int = MODEL_TOKENS,
    factory: EncoderFactory | None = None,
) -> DataFrame:
    """(keys, batch, vector): the encoder is called once for each batch of texts of like length."""
    encoder = made_encoder(factory or hashed_words_encoder())
    batches = length_batches(df, keys, text, batch_rows, model_tokens).drop("tokens")

    def encode(table: pa.Table) -> pa.Table:
        vectors = iter(encoder()([t for t in table.column(text).to_pylist() if t is not None]))
        found = [None if t is None else list(next(vectors)) for t in table.column(text).to_pylist()]
        columns = [*(table.column(k) for k in keys), table.column("batch"), pa.array(found, pa.list_(pa.float64()))]
        return pa.Table.from_arrays(columns, [*keys, "batch", output])

    return _per_batch(batches, keys, f"`{output}` array<double>", encode)
