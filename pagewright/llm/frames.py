"""Small helpers that every operator of this subpackage uses."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.sinks import tables as sink

#: Rows and bytes that ``work`` gets at a time: long texts must fit a Python worker many at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of bounded rows and, as far as single rows allow, bytes.

    Spark itself ends a batch at ``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB unless set.
    """
    for batch in batches:
        step = BATCH_ROWS
        if batch.nbytes > BATCH_BYTES:
            step = max(1, min(step, batch.num_rows * BATCH_BYTES // batch.nbytes))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def map_texts(
    df: DataFrame,
    columns: dict[str, Column],
    schema: str,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> DataFrame:
    """Run ``work`` over Arrow batches that hold just ``columns`` of ``df``.

    The frame may run long after this call, and Spark reads the batch size only then, so the
    session's ``maxRecordsPerBatch`` is lowered to ``BATCH_ROWS`` here and stays so. It is never raised.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(setting))
    if now <= 0 or now > BATCH_ROWS:
        df.sparkSession.conf.set(setting, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return work(small_batches(batches))

    return df.select(*(value.alias(name) for name, value in columns.items())).mapInArrow(run, schema)


@contextmanager
def short_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[None]:
    """Short Arrow batches for the jobs that are run inside; the session's own settings come back after."""
    wanted = {"maxRecordsPerBatch": rows, "maxBytesPerBatch": size}
    before = {name: spark.conf.get(f"spark.sql.execution.arrow.{name}") for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)


def raw_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; a null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def id_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the application's part of the shared folder."""
    return f"{sink.run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Write ``df`` under the shared folder and return the written table: the lineage ends here."""
    path = run_folder(df.sparkSession, label)
    with short_batches(df.sparkSession, size=batch_bytes):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_column: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text falls on ``remainder``; a null id is text of its own."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus == remainder
