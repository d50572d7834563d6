"""Documents to pages, page counts and page lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_pages(
    documents: DataFrame, key: str = "path", text: str = "text", page_chars: int = 1000
) -> DataFrame:
    """Cut each document into consecutive pages: (key, page from 0, page_text).

    One pass of a regular expression over the text yields all pages. Repeated
    ``substring`` calls would count characters from the start for every page. A document
    with empty text has one empty page, one with null text has none.
    """
    # Possessive: takes a full page at once and never backtracks.
    pages = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{page_chars}}}+"), F.lit(0))
    pages = F.when(F.col(text) == "", F.array(F.lit(""))).otherwise(pages)
    return documents.select(key, F.posexplode(pages).alias("page", "page_text"))


def page_total(pages: DataFrame) -> DataFrame:
    return pages.agg(F.count("*").alias("n_pages"))


def pages_per_document(pages: DataFrame, key: str = "path") -> DataFrame:
    return pages.groupBy(key).agg(F.count("*").alias("n_pages"))


def last_page(pages: DataFrame, key: str = "path", page: str = "page") -> DataFrame:
    """Largest page number of each document (pages count from 0)."""
    return pages.groupBy(key).agg(F.max(page).alias("last_page"))


def lookup(df: DataFrame, **values: object) -> DataFrame:
    """Rows whose columns equal the given values; the equalities reach the scan."""
    condition = F.lit(True)
    for column, value in values.items():
        condition = condition & (F.col(column) == F.lit(value))
    return df.filter(condition)


def lookup_batch(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``: one semi join in place of a query per key."""
    return df.join(keys.select(*on), on, "left_semi")


def with_suffix(df: DataFrame, column: str, suffix: str) -> DataFrame:
    """Rows whose column ends with ``suffix`` (``LIKE '%suffix'``)."""
    return df.filter(F.endswith(F.col(column), F.lit(suffix)))


def sample_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows in a stated order, so that every run returns the same ones."""
    return df.orderBy(*order).limit(n)
