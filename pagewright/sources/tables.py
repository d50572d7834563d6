"""Scans: parquet tables, catalog tables, binary files and whole text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("date", T.StringType(), False),
        T.StructField("file_name", T.StringType(), True),
    ]
)


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One parquet table of a directory."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, partitions: int | None, by: list[str] | None = None) -> DataFrame:
    """Give costly per-row work ``partitions`` tasks; None leaves the scan as it is.

    A scan of a large table has tasks enough; a small file with one row group has not.
    ``by`` names columns with many distinct values to hash on; dealing rows out in turn
    sorts them first and is slower.
    """
    return df if partitions is None else df.repartition(partitions, *(by or []))


def scan_binary_files(
    spark: SparkSession, directory: str, glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """Files of a directory as (path, modificationTime, length, content).

    A listing that does not select ``content`` does not open the files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(directory)


def scan_whole_text(spark: SparkSession, path: str, column: str = "speech_text") -> DataFrame:
    """One row per text file holding its whole content, plus any partition columns."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", column)


def manifest(
    df: DataFrame,
    title: Column,
    url: Column,
    date: Column,
    file_name: Column | None = None,
    on_null: str = "raise",
) -> DataFrame:
    """Rows of ``MANIFEST_SCHEMA``, nullability included, from any table.

    A row without title, URL or date, or with a blank one, breaks the contract: ``raise``
    fails the job, ``drop`` leaves such rows out and ``manifest_rejects`` returns them.
    """
    if on_null not in ("raise", "drop"):
        raise ValueError(f"on_null must be 'raise' or 'drop', not {on_null!r}")
    required = {"title": title, "url": url, "date": date}
    missing = F.lit(None).cast("string") if file_name is None else file_name.cast("string")
    shaped = df.select(*(c.cast("string").alias(n) for n, c in required.items()), missing.alias("file_name"))
    if on_null == "drop":
        for name in required:
            shaped = shaped.filter(~_blank(F.col(name)))
    told = {n: F.when(~_blank(F.col(n)), F.col(n)).otherwise(F.raise_error(f"manifest row without {n}")) for n in required}
    # A coalesce that ends in a literal is not null for the optimizer; the value before it never is.
    declared = [F.coalesce(c, F.lit("")).alias(n) for n, c in told.items()]
    return shaped.select(*declared, "file_name").select(*MANIFEST_SCHEMA.names)


def _blank(column: Column) -> Column:
    return column.isNull() | (F.trim(column) == "")


def manifest_rejects(df: DataFrame, title: Column, url: Column, date: Column) -> DataFrame:
    """Input rows that lack a title, a URL or a date."""
    return df.filter(_blank(title.cast("string")) | _blank(url.cast("string")) | _blank(date.cast("string")))
