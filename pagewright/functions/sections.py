"""Page layout expressions: typed blocks of a page and the sections built from them.

Everything here works inside one row (a page), so a page never has to be shuffled to be
sectioned, however the pages are spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.functions.binding import let
from pagewright.functions.text import strip

TITLE, TEXT, LIST = "Title", "Text", "List"

# The tags that open a block and the block type each one stands for.
BLOCK_TAGS = {
    "<h1>": TITLE,
    "<p>": TEXT,
    '<div class="ad">': TEXT,
    "<footer>": TEXT,
    "<li>": LIST,
}

SECTION_SCHEMA = T.ArrayType(
    T.StructType(
        [
            T.StructField("title", T.StringType(), True),
            T.StructField("texts", T.ArrayType(T.StringType()), True),
            T.StructField("continuation", T.BooleanType(), True),
        ]
    )
)


def html_blocks(html: Column, tags: dict[str, str] = BLOCK_TAGS) -> Column:
    """Array of (kind, text) blocks of a page in reading order; text is tag-free and stripped.

    ``tags`` maps each literal opening tag to its block type. A block runs from its opening
    tag to the next one, so unclosed tags do no harm. What precedes the first block is not
    a block.
    """
    # The split eats the "<" of the opening tag: with a literal first the matcher skips
    # ahead quickly. The first piece is what precedes the first block.
    names = [tag.removeprefix("<") for tag in tags]
    opening = "<(?=" + "|".join(f"\\Q{name}\\E" for name in names) + ")"

    def block(piece: Column) -> Column:
        kind = F.lit(None).cast("string")
        for name, tag in zip(names, tags):
            kind = F.when(F.startswith(piece, F.lit(name)), tags[tag]).otherwise(kind)
        text = F.regexp_replace(F.concat(F.lit("<"), piece), "<[^>]*>", " ")
        return F.struct(kind.alias("kind"), strip(text).alias("text"))

    return F.transform(F.filter(F.split(html, opening), lambda p, i: i > 0), block)


def order_blocks(blocks: Column, by: str = "y") -> Column:
    """Blocks sorted by one field; blocks level with each other keep the order they had."""
    keyed = F.transform(
        blocks, lambda b, i: F.struct(b[by].alias("key"), i.alias("index"), b.alias("block"))
    )
    return F.transform(
        F.array_sort(
            keyed,
            lambda a, b: F.when(a["key"] < b["key"], -1)
            .when(a["key"] > b["key"], 1)
            .otherwise(a["index"] - b["index"]),
        ),
        lambda k: k["block"],
    )


def page_titles(blocks: Column) -> Column:
    """Non-blank titles of a page, in order."""
    titles = F.filter(blocks, lambda b: (b["kind"] == TITLE) & (strip(b["text"]) != ""))
    return F.transform(titles, lambda b: strip(b["text"]))


def assemble_sections(blocks: Column, stripped: bool = False) -> Column:
    """Ordered blocks of one page to an array of (title, texts, continuation).

    A title opens a section and the texts after it belong to it. Texts before any title
    form one leading section with no title and ``continuation = true``; a titled section
    has a null continuation. Blank blocks and other block types are left out first, so a
    blank title opens nothing. ``stripped`` says that the block texts are stripped already.
    """
    if not stripped:
        blocks = F.transform(
            blocks, lambda b: F.struct(b["kind"].alias("kind"), strip(b["text"]).alias("text"))
        )
    usable = F.filter(blocks, lambda b: b["kind"].isin(TITLE, TEXT) & (b["text"] != ""))

    def first_positions(kept: Column) -> Column:
        marked = F.transform(kept, lambda b, i: F.when((i == 0) | (b["kind"] == TITLE), i))
        return F.filter(marked, lambda i: i.isNotNull())

    def section(kept: Column, starts: Column, start: Column, nth: Column) -> Column:
        head = F.get(kept, start)
        titled = head["kind"] == TITLE
        end = F.coalesce(F.get(starts, nth + 1), F.size(kept))
        body = start + F.when(titled, 1).otherwise(0)
        return F.struct(
            F.when(titled, head["text"]).alias("title"),
            F.transform(F.slice(kept, body + 1, end - body), lambda b: b["text"]).alias("texts"),
            F.when(~titled, F.lit(True)).alias("continuation"),
        )

    return let(
        usable,
        lambda kept: let(
            first_positions(kept),
            lambda starts: F.transform(
                starts, lambda start, nth: section(kept, starts, start, nth)
            ),
        ),
    )


def sections_to_json(sections: Column) -> Column:
    return F.to_json(sections)


def sections_from_json(text: Column) -> Column:
    """Decode sections; absent keys become null, unreadable text becomes null."""
    return F.from_json(text, SECTION_SCHEMA)
