"""URL expressions: file name, parts, query map, partition key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions.binding import let

# Generic URI syntax; groups are scheme, authority, path, query, fragment.
URL_PATTERN = (
    r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
)
# Schemes whose last path segment may carry ";params".
PARAM_SCHEMES = [
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
]


def url_file_name(url: Column, keep_query: bool = False) -> Column:
    """What follows the last slash; null when there is no slash or nothing after it."""
    pattern = r".*\/([^\/]+)" if keep_query else r".*\/([^\/?]+)"
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def file_name_or_derived(file_name: Column, url: Column) -> Column:
    """The supplied name when there is one, else the name taken from the URL."""
    return F.coalesce(F.nullif(file_name, F.lit("")), url_file_name(url))


def url_groups(url: Column) -> Column:
    """Array of scheme, authority, path and query, from one run of the pattern.

    The groups are parted by a control character; a URL that holds it takes a run per group.
    """
    mark = "\x01"
    parted = F.split(F.regexp_replace(url, URL_PATTERN, mark.join(f"${k}" for k in range(1, 6))), mark)
    each = F.array(*(F.regexp_extract(url, URL_PATTERN, k) for k in range(1, 5)))
    return F.when(F.instr(url, mark) > 0, each).otherwise(parted)


def url_struct(url: Column) -> Column:
    """Struct of scheme, site, path and query_string; the same as the functions below."""

    def parts(groups: Column) -> Column:
        scheme, path = F.lower(F.get(groups, F.lit(0))), F.get(groups, F.lit(2))
        return F.struct(
            scheme.alias("scheme"),
            F.get(groups, F.lit(1)).alias("site"),
            _without_params(scheme, path).alias("path"),
            F.get(groups, F.lit(3)).alias("query_string"),
        )

    return let(url_groups(url), parts)


def _without_params(scheme: Column, path: Column) -> Column:
    known = scheme.isin(PARAM_SCHEMES)
    return F.when(known, F.regexp_replace(path, ";[^/]*$", "")).otherwise(path)


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, URL_PATTERN, 1))


def url_site(url: Column) -> Column:
    """Authority with user-info and port; '' when missing."""
    return F.regexp_extract(url, URL_PATTERN, 2)


def url_path(url: Column) -> Column:
    """Path without the ``;params`` of its last segment."""
    return _without_params(url_scheme(url), F.regexp_extract(url, URL_PATTERN, 3))


def url_query_string(url: Column) -> Column:
    return F.regexp_extract(url, URL_PATTERN, 4)


def _decode(text: Column) -> Column:
    """Percent-decode; '+' is a space and a '%' without two hex digits stays as it is."""
    return F.try_url_decode(F.regexp_replace(text, "%(?![0-9a-fA-F]{2})", "%25"))


def query_pairs(query: Column) -> Column:
    """Array of (key, value) in order of appearance; pairs with a blank value are dropped."""
    pieces = F.filter(
        F.split(query, "&"),
        lambda p: (F.instr(p, "=") > 0) & (F.length(p) > F.instr(p, "=")),
    )
    return F.transform(
        pieces,
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("key"),
            _decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("value"),
        ),
    )


def query_map(query: Column) -> Column:
    """Query string to map<string, array<string>>; repeated keys keep their order."""
    # Keyed by the distinct keys of one URL, so the inner filter runs over a few pairs.
    return let(
        query_pairs(query),
        lambda pairs: F.map_from_entries(
            F.transform(
                F.array_distinct(F.transform(pairs, lambda p: p["key"])),
                lambda key: F.struct(
                    key.alias("key"),
                    F.transform(
                        F.filter(pairs, lambda p: p["key"] == key), lambda p: p["value"]
                    ).alias("value"),
                ),
            )
        ),
    )


def partition_key(site: Column, width: int = 2) -> Column:
    """Leading hex digits of md5(site): 16**width even buckets, the same on every run."""
    return F.substring(F.md5(site), 1, width)
