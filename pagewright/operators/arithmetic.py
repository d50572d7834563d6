"""Arrow functions over whole columns: numbers, and arrays of structs built from offsets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = "array<struct<kind:string,value:double>>"


def multiply_batches(a: Column, b: Column) -> Column:
    """Product of two columns, one Arrow batch at a time."""

    @F.arrow_udf("double")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pc.multiply(x, y)

    return run(a.cast("double"), b.cast("double"))


def named_parts(columns: dict[str, pa.Array]) -> pa.Array:
    """One array of (kind, value) for each row, with the columns in the order given.

    All rows have as many parts, so the offsets are known and no row becomes a Python object.
    """
    rows = len(next(iter(columns.values())))
    width = len(columns)
    values = pa.concat_arrays(list(columns.values())).take(pa.array(np.arange(width * rows).reshape(width, rows).T.ravel()))
    kinds = pa.array(list(columns), pa.string()).take(pa.array(np.tile(np.arange(width), rows)))
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1, dtype=np.int32) * width, pa.int32()), pa.StructArray.from_arrays([kinds, values], ["kind", "value"])
    )


def price_parts(quantity: Column, price: Column, discount: Column) -> Column:
    """Gross amount, discount and net amount of each row as an array of named parts.

    For results that only Python can give; built-in expressions are faster where they exist. A
    part whose amounts are null is null.
    """

    @F.arrow_udf(PARTS)
    def run(q: pa.Array, p: pa.Array, d: pa.Array) -> pa.Array:
        gross = pc.multiply(q, p)
        off = pc.multiply(gross, d)
        return named_parts({"gross": gross, "discount": off, "net": pc.subtract(gross, off)})

    return run(*(c.cast("double") for c in (quantity, price, discount)))
