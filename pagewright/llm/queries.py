"""One query for each operator of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import bpe, collocations, debruijn, decontam, langid, lexical, licenses, minhash, quality, ring, suffixes, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(_table(spark, sf_dir, "pages"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_report(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.shard_documents(_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.span_report(_table(spark, sf_dir, "documents"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_bpe": op2_bpe,
    "op3_warc": op3_warc,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_licenses": op6_licenses,
    "op7_decontaminate": op7_decontaminate,
    "op8_language": op8_language,
    "op9_shards": op9_shards,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_collocations": op11_collocations,
    "op12_span_dedup": op12_span_dedup,
    "op13_search": op13_search,
}
