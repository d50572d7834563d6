"""Content of each manifest URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import urls as U
from pagewright.operators.skew import hot_keys, lookup_join, salted_matches, salted_rows


def url_parts(df: DataFrame, url: str = "url", keys: list[str] | None = None) -> DataFrame:
    """URL split into scheme, site, path and query string, '' where a part is missing."""
    return df.select(*(keys or []), url, U.url_struct(F.col(url)).alias("p")).select(*(keys or []), url, "p.*")


def query_values(df: DataFrame, url: str = "url", keys: list[str] | None = None) -> DataFrame:
    """The query map as rows: key, position of the value under its key, value."""
    keys = keys or []
    query = U.query_map(U.url_query_string(F.col(url)))
    entries = df.select(*keys, F.explode(query).alias("key", "values"))
    return entries.select(*keys, "key", F.posexplode("values").alias("position", "value"))


def _version(content: str, newest_by: str, *more: Column) -> Column:
    """What tells the copies of a URL apart: the greatest is the one that counts.

    A copy without a version comes before all others, and copies of one version go by the
    digest of their content, so the choice is the same on every run.
    """
    return F.struct(F.col(newest_by).alias("version"), F.sha2(F.col(content).cast("binary"), 256).alias("digest"), *more)


def newest_content(landed: DataFrame, url: str, content: str, newest_by: str, by: list[str] | None = None) -> DataFrame:
    """One row (url, content) per landed URL: its newest copy. ``by`` are more columns to group by.

    Each task keeps the newest of the copies it reads, so contents are shuffled once and older
    copies mostly not at all.
    """
    keys = [url, *(by or [])]
    copies = landed.select(*keys, F.col(content).alias("content"), _version(content, newest_by).alias("_copy"))
    return copies.groupBy(*keys).agg(F.max_by("content", "_copy").alias("content"))


def resolve_content(
    manifest: DataFrame,
    landed: DataFrame,
    url: str = "url",
    content: str = "content",
    newest_by: str = "modificationTime",
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Every manifest row with ``found`` and ``n_bytes``.

    When a URL landed more than once the newest copy counts; see ``newest_content`` for ties
    and copies without a version. Only lengths are grouped and joined, the content stays in
    its scan. A URL listed very often is salted; see ``lookup_join``.
    """
    n_bytes = F.octet_length(content).cast("bigint")
    newest = landed.groupBy(url).agg(
        F.max(_version(content, newest_by, n_bytes.alias("n_bytes")))["n_bytes"].alias("n_bytes"),
        F.lit(True).alias("_found"),
    )
    joined = lookup_join(manifest, newest, [url], hot_keys(manifest, url), spread_by)
    return joined.withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found")


def with_content(
    manifest: DataFrame,
    landed: DataFrame,
    url: str = "url",
    content: str = "content",
    newest_by: str = "modificationTime",
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Every manifest row once, with its ``content``, null when nothing landed.

    The copies of a URL that is listed very often get its salts before the newest is chosen, so
    what chooses them also deals them out for the join: content goes through one exchange.
    """
    hot = hot_keys(manifest, url)
    newest = newest_content(salted_matches(landed, url, hot), url, content, newest_by, ["_salt"])
    return salted_rows(manifest, url, hot, spread_by).join(newest, [url, "_salt"], "left").drop("_salt")


def attach_content(manifest: DataFrame, newest: DataFrame, url: str = "url", spread_by: list[str] | None = None) -> DataFrame:
    """``with_content`` from a table that holds one row (url, content) per URL."""
    return lookup_join(manifest, newest, [url], hot_keys(manifest, url), spread_by)
