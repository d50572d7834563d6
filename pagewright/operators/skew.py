"""Joins to one-row-per-key tables when one key may hold much of the other side."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than this share of the rows, so there are fewer than
# 1 / HOT_SHARE hot keys whatever the data: that is the bound on what gets broadcast.
HOT_SHARE = 0.001


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """(key, fan_out) of keys holding more than ``share`` of the rows: fewer than ``1 / share``.

    ``fan_out`` is the key's share of the rows in units of ``share``, rounded up, so that all
    of them add up to less than ``2 / share``. Reads the key column only and counts before
    it shuffles.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return _above(counts, key, "_n", df.agg(F.count("*")).scalar(), share)


def heavy_keys(weighted: DataFrame, key: str | list[str], weight: str, share: float = HOT_SHARE) -> DataFrame:
    """``hot_keys`` of a table that already holds one row per key, of one or more columns, and its row count."""
    return _above(weighted, key, weight, weighted.agg(F.sum(weight)).scalar(), share)


def _columns(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else key


def _above(counts: DataFrame, key: str | list[str], weight: str, total: Column, share: float) -> DataFrame:
    unit = total * F.lit(share)
    fan_out = F.ceil(F.col(weight) / unit).cast("int").alias("fan_out")
    return counts.filter(F.col(weight) > unit).select(*_columns(key), fan_out)


def lookup_join(
    left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame, spread_by: list[str] | None = None
) -> DataFrame:
    """Left outer join to ``right``, which holds one row per value of ``on``.

    ``hot`` lists the hot values of all columns of ``on`` together with their fan-out. Their
    rows are spread over that many salts, and the matching right row is repeated once per
    salt: in all less than ``2 / HOT_SHARE`` copies, however many cores there are. Values of
    some of the columns would not do: each has as many right rows as the others have values,
    and all of them would be repeated. The salt is a hash of ``spread_by``, or without it the row's place in the scan, which tells equal rows
    apart too. Rows without a key match nothing and are spread as well. Nothing is dropped:
    the result equals the plain left join.
    """
    salted_left, salted_right = salted_rows(left, on, hot, spread_by), salted_matches(right, on, hot)
    return salted_left.join(salted_right, [*on, "_salt"], "left").drop("_salt")


def _marked(hot: DataFrame, keys: list[str]) -> DataFrame:
    return F.broadcast(hot.select(*keys, F.col("fan_out").alias("_fan")))


def salted_rows(left: DataFrame, key: str | list[str], hot: DataFrame, spread_by: list[str] | None = None) -> DataFrame:
    """The many side of ``lookup_join``: each row with one ``_salt`` of its key."""
    keys = _columns(key)
    place = F.xxhash64(*spread_by) if spread_by else F.monotonically_increasing_id()
    placed = left.withColumn("_place", place)
    keyless = functools.reduce(operator.or_, (F.col(k).isNull() for k in keys))
    fan = F.when(keyless, F.lit(int(1 / HOT_SHARE))).otherwise(F.coalesce("_fan", F.lit(1)))
    salted = placed.join(_marked(hot, keys), keys, "left").withColumn("_salt", F.pmod(F.col("_place"), fan).cast("int"))
    return salted.drop("_fan", "_place")


def salted_matches(right: DataFrame, key: str | list[str], hot: DataFrame) -> DataFrame:
    """The other side: each row once for every ``_salt`` of its key."""
    keys = _columns(key)
    salts = F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1)
    return right.join(_marked(hot, keys), keys, "left").withColumn("_salt", F.explode(salts)).drop("_fan")
