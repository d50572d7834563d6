"""Table output: overwrite, partitioned write, create-as-select, lifecycle and details."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.urls import partition_key
from pagewright.operators.skew import hot_keys

DEFAULT_FORMAT = "parquet"


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, else the session's warehouse.

    The same rule for every master.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables go."""
    return f"{shared_folder(spark)}/pagewright/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder and return the written table.

    Cuts the lineage: what comes after reads files and never recomputes ``df``. The files
    stay until ``remove_materialized``.
    """
    path = f"{run_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_materialized(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; their DataFrames cannot be read after."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in whatever file system it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def save_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    fmt: str = DEFAULT_FORMAT,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Overwrite a catalog table, its schema included, and return the new table."""
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def with_partition(df: DataFrame, site: Column, column: str = "partition") -> DataFrame:
    return df.withColumn(column, partition_key(site))


def save_partitioned(
    df: DataFrame,
    name: str,
    partition: str = "partition",
    path: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> DataFrame:
    """Overwrite a table partitioned by one column.

    Rows are gathered by partition value first, so a task does not open a file in every
    partition. A value with much of the rows is still written by many tasks: adaptive
    execution splits what the rebalance leaves too big, and where that is switched off
    a value gets as many salts as its share of the rows asks for.
    """
    if _splits_big_partitions(df.sparkSession):
        gathered = df.hint("rebalance", partition)
    else:
        hot = hot_keys(df, partition).withColumnRenamed("fan_out", "_fan")
        placed = df.withColumn("_place", F.monotonically_increasing_id())
        fan = F.coalesce("_fan", F.lit(1))
        salted = placed.join(F.broadcast(hot), partition, "left").withColumn("_salt", F.pmod("_place", fan))
        gathered = salted.drop("_place", "_fan").hint("rebalance", partition, "_salt").drop("_salt")
        gathered = gathered.select(*df.columns)
    return save_table(gathered, name, path, fmt, [partition])


def _splits_big_partitions(spark: SparkSession) -> bool:
    settings = (
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled",
    )
    return all(spark.conf.get(s) == "true" for s in settings)


def create_table_as(
    spark: SparkSession,
    name: str,
    query: str,
    path: str | None = None,
    fmt: str = DEFAULT_FORMAT,
    replace: bool = True,
) -> DataFrame:
    """``CREATE [OR REPLACE] TABLE name AS query``.

    Formats without an atomic replace get the same by overwriting; without ``replace``
    an existing table is an error.
    """
    df = spark.sql(query)
    if replace:
        return save_table(df, name, path, fmt)
    writer = df.write.format(fmt).mode("error")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_database(spark: SparkSession, name: str, cascade: bool = False) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name}{' CASCADE' if cascade else ''}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns and types of a table, in order."""
    described = spark.sql(f"DESCRIBE TABLE {name}")
    return described.select("col_name", "data_type")


def table_detail(table: DataFrame, partition: str | None = None) -> DataFrame:
    """Files, bytes and rows of a file table, per partition value if there is one.

    Reads file footers only: no data column is selected.
    """
    keys = [partition] if partition else []
    files = table.select(
        *keys,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    per_file = files.groupBy(*keys, "file_path", "file_size").agg(F.count("*").alias("n"))
    return per_file.groupBy(*keys).agg(
        F.count("*").alias("num_files"),
        F.sum("file_size").alias("size_in_bytes"),
        F.sum("n").alias("num_rows"),
    )


def listed_files(spark: SparkSession, folder: str, partition: str | None = None) -> DataFrame:
    """Files and bytes of a table's folder, per partition value if there is one, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder)
    keys = [F.regexp_extract("path", f"/{partition}=([^/]*)/", 1).alias(partition)] if partition else []
    return files.groupBy(*keys).agg(F.count("*").alias("num_files"), F.sum("length").alias("size_in_bytes"))


def read_partitions_of(table: DataFrame, wanted: DataFrame, partition: str, on: list[str]) -> DataFrame:
    """Rows of a partitioned table whose values of ``on`` are among ``wanted``, from their partitions alone.

    ``wanted`` holds ``on`` and the partition column, and may have been filtered by anything. Its
    different partition values, which are at most as many as the table's partitions, are broadcast
    and prune the scan while the query runs; a plain semi-join then keeps the rows that are asked for.
    """
    values = wanted.select(partition).distinct()
    pruned = table.join(F.broadcast(values), partition, "left_semi")
    keys = wanted.select(partition, *on).distinct()
    return pruned.join(keys, [partition, *on], "left_semi")


def partitions_of(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")
