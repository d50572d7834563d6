"""The document flow: pages, sections, flat section text, counts, vectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators import content as C
from pagewright.operators.embedding import EncoderFactory, embed_texts
from pagewright.operators.paging import split_pages
from pagewright.sinks.tables import create_database, save_table


@dataclass(frozen=True)
class DocumentTables:
    """Catalog names of the tables the flow writes."""

    database: str = "documents"
    location: str | None = None

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def path(self, table: str) -> str | None:
        return f"{self.location.rstrip('/')}/{table}" if self.location else None


def section_counts(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Pages to texts per titled section, as one lazy plan.

    Blocks, sections and counts are made inside the page's row. Only (keys, section,
    title, count) is shuffled for the grouping and the final order.
    """
    return C.count_section_texts(C.page_sections(pages, keys, html), keys)


def expanded_content(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Pages to one row per section text; needs no shuffle."""
    return C.expand_sections(C.page_sections(pages, keys, html), keys)


def text_embeddings(
    pages: DataFrame, keys: list[str], html: str = "html", factory: EncoderFactory | None = None
) -> DataFrame:
    """Pages to one vector per section text."""
    return embed_texts(expanded_content(pages, keys, html), factory=factory)


def document_pages(documents: DataFrame, key: str, text: str, page_chars: int) -> DataFrame:
    """Documents to (path, page, page_text)."""
    pages = split_pages(documents.withColumnRenamed(key, "path"), "path", text, page_chars)
    return pages.withColumn("path", F.col("path").cast("string"))


def write_document_tables(
    spark: SparkSession,
    pages: DataFrame,
    keys: list[str],
    tables: DocumentTables = DocumentTables(),
    html: str = "html",
) -> dict[str, DataFrame]:
    """Run the flow table by table: pages, document_titles, expanded_content, counts.

    Each stage reads the table written before it, so a lost executor or a failed stage
    costs that stage only.
    """
    create_database(spark, tables.database)

    def save(df: DataFrame, table: str) -> DataFrame:
        return save_table(df, tables.name(table), tables.path(table))

    content = save(C.page_sections(pages, keys, html), "pages")
    titles = save(C.section_titles(content, keys), "document_titles")
    expanded = save(C.order_content(C.expand_sections(content, keys), keys), "expanded_content")
    counts = save(C.section_text_counts(expanded, keys), "section_text_counts")
    return {
        "pages": content,
        "document_titles": titles,
        "expanded_content": expanded,
        "section_text_counts": counts,
    }
