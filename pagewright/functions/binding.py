"""Bind an expression once so that a lambda can use its value many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed a single time per row.

    A column used inside a lambda may be inlined by the optimizer and then run once per
    array element. Passing it through a one-element ``transform`` makes it a lambda
    variable, which is a plain lookup.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_rows(array: Column) -> Column:
    """The same array, for use in ``explode`` and ``posexplode``.

    For a bare column the optimizer adds ``size(column) > 0`` below the generator and
    pushes it down with the column's whole expression, which then runs several times.
    It leaves other expressions alone.
    """
    return F.transform(array, lambda item: item)
