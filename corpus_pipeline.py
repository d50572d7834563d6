"""The training-text pipeline: stages that each take and return documents.

1. Toxic documents go. 2. One document of each near-duplicate class stays. 3. Strings of
``REPEAT_BYTES`` bytes that repeat across or within documents are cut out. 4. Benchmark passages
are cut out. 5. What is left is encoded.

Every stage looks at all rows and whole texts that the stage before kept, and all but the last
return the columns of ``documents``. A document that a stage finds nothing in is kept as it is.
A text that is cut gets a new ``n_chars``, and a document that cutting leaves blank goes. Null
and empty texts pass all stages; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import bpe, decontam, minhash, suffixes, toxicity
from pagewright.llm.frames import written


#: About 50 words: in the test tables 51 words have fewer bytes in one place of a hundred, and 400 bytes
#: would be most of 70 words. Of 9236 documents of sf0.1 that reach the stage, 1149 share 51 words with
#: another place; 250 bytes cut 1147 of them and 219 others, which share somewhat shorter passages, 200 bytes 1149 and 348.
REPEAT_BYTES = 250


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.cut_repeats(docs, length=REPEAT_BYTES)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_contamination(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their digests."""
    found = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), with_decoded=False)
    return found.select(F.col("doc_id"), "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("benchmark", cut_benchmark),
    ("tokens", encode),
]

#: Most stages cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
