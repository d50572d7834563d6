"""Text to vectors in Arrow batches, and similarity to one vector."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import vectors as V

# An encoder takes a list of texts and returns one list of floats per text. It is made
# by a factory, so that a model is loaded on the worker and not sent with the plan.
Encoder = Callable[[list[str]], list[list[float]]]
EncoderFactory = Callable[[], Encoder]


def hashed_words_encoder(dims: int = 64) -> EncoderFactory:
    """Factory of the default encoder: word counts in md5 buckets, scaled to length 1."""

    def make():
        import hashlib
        import re

        import numpy as np

        word = re.compile("[0-9a-z_]+")

        class Buckets(dict):
            def __missing__(self, token):
                self[token] = bucket = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dims
                return bucket

        def encode(texts):
            bucket_of = Buckets().__getitem__  # of one batch: it never outgrows its texts
            vectors = []
            for text in texts:
                buckets = list(map(bucket_of, word.findall(text.lower())))
                counts = np.bincount(buckets, minlength=dims) if buckets else np.zeros(dims)
                norm = np.sqrt(float((counts * counts).sum()))
                vectors.append((counts / norm if norm else counts).astype("float64"))
            return vectors

        return encode

    return make


# Encoders of this process by the digest of their factory. Worker processes are reused.
_ENCODERS: dict[str, Encoder] = {}


def _encoder_of(digest: str, factory: bytes) -> Encoder:
    if digest not in _ENCODERS:
        _ENCODERS[digest] = cloudpickle.loads(factory)()
    return _ENCODERS[digest]


def made_encoder(factory: EncoderFactory) -> Callable[[], Encoder]:
    """What gives the factory's encoder on a worker: made by the first call in a process, reused by all others."""
    packed = cloudpickle.dumps(factory)
    digest = hashlib.sha256(packed).hexdigest()
    return lambda: _encoder_of(digest, packed)


def embed(text: Column, factory: EncoderFactory | None = None) -> Column:
    """Vector of each text as array<double>; null text gives null.

    The encoder is made once per worker process and serves all tasks that run there.
    """
    encoder = made_encoder(factory or hashed_words_encoder())

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder()
        for batch in batches:
            present = batch.notna()
            out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            vectors = list(encode(batch[present].tolist()))
            for position, vector in zip(batch.index[present], vectors, strict=True):
                out.at[position] = vector
            yield out

    return run(text)


def embed_texts(
    df: DataFrame, text: str = "text", output: str = "text_bert_embeddings",
    factory: EncoderFactory | None = None,
) -> DataFrame:
    """Table with the vector of ``text``; title and text themselves are left out."""
    dropped = {text, "title"}
    kept = [c for c in df.columns if c not in dropped]
    return df.select(*kept, embed(F.col(text), factory).alias(output))


def cosine_to_row(df: DataFrame, key: str, vector: str, row: object) -> DataFrame:
    """Cosine similarity of every other row to the row whose key is ``row``.

    The one vector is a scalar subquery, not a join; a key that is not unique fails.
    """
    one = df.filter(F.col(key) == F.lit(row))
    anchor = one.select(
        F.struct(F.col(vector).alias("vector"), V.norm(F.col(vector)).alias("norm"))
    ).scalar()
    others = df.filter(F.col(key) != F.lit(row)).select(key, vector, anchor.alias("anchor"))
    similarity = V.cosine(F.col(vector), F.col("anchor.vector"), norm_b=F.col("anchor.norm"))
    return others.select(key, similarity.alias("similarity"))
