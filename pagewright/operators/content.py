"""Pages to blocks, sections and flat section text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import sections as S
from pagewright.functions.binding import as_rows


def with_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the page source by its ``blocks`` array of (kind, text)."""
    return pages.withColumn("blocks", S.html_blocks(F.col(html))).drop(html)


def layout_blocks(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """One row per block: keys, block_index, kind, text."""
    blocks = pages.select(*keys, F.posexplode(S.html_blocks(F.col(html))).alias("block_index", "b"))
    return blocks.select(*keys, "block_index", "b.kind", "b.text")


def page_titles(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """One row per title: keys, title_index_in_page, title."""
    titles = S.page_titles(S.html_blocks(F.col(html)))
    return pages.select(*keys, F.posexplode(titles).alias("title_index_in_page", "title"))


def page_sections(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """One row per page: keys, image_content (array of title, texts, continuation)."""
    sections = S.assemble_sections(S.html_blocks(F.col(html)), stripped=True)
    return pages.select(*keys, sections.alias("image_content"))


def blocks_by_page(
    blocks: DataFrame, keys: list[str], y: str = "y", arrival: str = "block_index", kind: str = "kind", text: str = "text"
) -> DataFrame:
    """Block rows, arriving in any order, to one row per page: keys, blocks from top to bottom.

    Blocks level with each other keep the order of ``arrival``, and a block without a ``y`` comes
    first. A page is one row, so nothing is held together but its own blocks.
    """
    height = F.coalesce(F.col(y).cast("double"), F.lit(float("-inf")))
    found = F.collect_list(F.struct(F.col(arrival).alias("arrival"), height.alias("y"), F.col(kind).alias("kind"), F.col(text).alias("text")))
    pages = blocks.groupBy(*keys).agg(F.sort_array(found).alias("blocks"))
    return pages.withColumn("blocks", S.order_blocks(F.col("blocks"), by="y"))


def sections_from_blocks(
    blocks: DataFrame, keys: list[str], y: str = "y", arrival: str = "block_index", kind: str = "kind", text: str = "text"
) -> DataFrame:
    """``page_sections`` from the blocks that a layout detector found: keys, image_content."""
    pages = blocks_by_page(blocks, keys, y, arrival, kind, text)
    return pages.select(*keys, S.assemble_sections(F.col("blocks")).alias("image_content"))


def section_titles(page_content: DataFrame, keys: list[str]) -> DataFrame:
    """``page_titles`` from page content: every non-blank title has opened a section."""
    titles = F.filter(F.transform("image_content", lambda s: s["title"]), lambda t: t.isNotNull())
    return page_content.select(*keys, F.posexplode(titles).alias("title_index_in_page", "title"))


def sections(page_content: DataFrame, keys: list[str], keep_empty: bool = False) -> DataFrame:
    """One row per section: keys, section_index, title, texts, continuation."""
    explode = F.posexplode_outer if keep_empty else F.posexplode
    content = as_rows(F.col("image_content"))
    rows = page_content.select(*keys, explode(content).alias("section_index", "s"))
    return rows.select(*keys, "section_index", "s.title", "s.texts", "s.continuation")


def expand_sections(page_content: DataFrame, keys: list[str], keep_empty: bool = False) -> DataFrame:
    """One row per text: keys, section_index, title, continuation, text_index, text.

    Pages without sections and sections without texts give no row unless ``keep_empty``.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return sections(page_content, keys, keep_empty).select(
        *keys,
        "section_index",
        "title",
        "continuation",
        explode("texts").alias("text_index", "text"),
    )


def order_content(expanded: DataFrame, keys: list[str]) -> DataFrame:
    """Reading order over the whole table (a range shuffle; splits inside a page too)."""
    return expanded.orderBy(*keys, "section_index", "text_index")


def section_text_counts(expanded: DataFrame, keys: list[str], ordered: bool = True) -> DataFrame:
    """Texts per titled section of an expanded table, in reading order."""
    counts = (
        expanded.filter(F.col("title").isNotNull())
        .groupBy(*keys, "section_index", "title")
        .agg(F.count("text").alias("n_texts"))
    )
    return counts.orderBy(*keys, "section_index") if ordered else counts


def count_section_texts(page_content: DataFrame, keys: list[str], ordered: bool = True) -> DataFrame:
    """``section_text_counts`` straight from page content.

    The texts are counted inside their row and only the counts are grouped, so no text
    is exploded or shuffled. Sections without texts are left out, as exploding does.
    """
    rows = sections(page_content, keys).filter(F.col("title").isNotNull() & (F.size("texts") > 0))
    counts = (
        rows.withColumn("n", F.size(F.filter("texts", lambda t: t.isNotNull())))
        .groupBy(*keys, "section_index", "title")
        .agg(F.sum("n").alias("n_texts"))
    )
    return counts.orderBy(*keys, "section_index") if ordered else counts


def json_roundtrip(page_content: DataFrame, keys: list[str]) -> DataFrame:
    """Sections written to JSON text and decoded again with the declared schema."""
    as_json = page_content.select(*keys, S.sections_to_json(F.col("image_content")).alias("json"))
    return as_json.select(*keys, S.sections_from_json(F.col("json")).alias("image_content"))


def joined_texts(sections_column: Column, separator: str = " ") -> Column:
    """All texts of a page's sections as one string."""
    return F.array_join(
        F.flatten(F.transform(sections_column, lambda s: s["texts"])), separator
    )
