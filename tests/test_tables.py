import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from pagewright.session import shuffle_partitions
from pagewright.sinks import tables as K
from pagewright.sources import tables as A


def test_manifest_contract(spark):
    rows = [("t", "u", "02 Oct 2002"), (None, "v", "x"), ("w", None, "y"), (" ", "b", "z"), ("n", "d", None)]
    df = spark.createDataFrame(rows, "a string, b string, d string")
    a, b, d = F.col("a"), F.col("b"), F.col("d")
    good = A.manifest(df, a, b, d, on_null="drop")
    assert [(f.name, f.nullable) for f in good.schema] == [(f.name, f.nullable) for f in A.MANIFEST_SCHEMA]
    assert [tuple(r) for r in good.collect()] == [("t", "u", "02 Oct 2002", None)]
    assert A.manifest_rejects(df, a, b, d).count() == 4
    with pytest.raises(Exception, match="manifest row without (title|url|date)"):
        A.manifest(df, a, b, d).collect()
    with pytest.raises(ValueError):
        A.manifest(df, a, b, d, on_null="ignore")


def test_binary_scan(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"12345")
    (tmp_path / "b.txt").write_bytes(b"1")
    files = A.scan_binary_files(spark, str(tmp_path), "*.bin")
    assert files.columns == ["path", "modificationTime", "length", "content"]
    row = files.head()
    assert (row.path.rsplit("/", 1)[1], row.length, bytes(row.content)) == ("a.bin", 5, b"12345")


def test_whole_text(spark, tmp_path):
    (tmp_path / "speech.txt").write_text("line one\nline two\n", encoding="utf-8")
    rows = A.scan_whole_text(spark, str(tmp_path)).collect()
    assert [r.speech_text for r in rows] == ["line one\nline two\n"]


def test_spread(spark):
    one = spark.range(0, 10, 1, 1)
    assert A.spread(one, 3).rdd.getNumPartitions() == 3
    by_id = A.spread(one, 5, by=["id"])
    assert by_id.rdd.getNumPartitions() == 5 and "hashpartitioning(id" in plan_of(by_id)
    assert A.spread(one, None) is one


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    K.save_table(spark.range(5).withColumn("x", F.lit("a")), "over_t", path)
    table = K.save_table(spark.range(3).withColumn("y", F.lit(1.5)), "over_t", path)
    assert table.columns == ["id", "y"] and table.count() == 3
    K.drop_table(spark, "over_t")


def test_create_table_as(spark):
    made = K.create_table_as(spark, "ctas_t", "SELECT id, 'someone' AS who FROM range(4)")
    assert made.count() == 4
    K.create_table_as(spark, "ctas_t", "SELECT id FROM range(2)")
    assert spark.table("ctas_t").columns == ["id"]
    with pytest.raises(Exception):
        K.create_table_as(spark, "ctas_t", "SELECT 1 AS x", replace=False)
    K.drop_table(spark, "ctas_t")


def test_lifecycle(spark):
    K.create_database(spark, "life_db")
    K.create_database(spark, "life_db")
    K.use_database(spark, "life_db")
    spark.range(1).write.saveAsTable("t")
    assert [tuple(r) for r in K.describe_table(spark, "life_db.t").collect()] == [("id", "bigint")]
    K.drop_table(spark, "t")
    K.drop_table(spark, "t")
    K.use_database(spark, "default")
    K.drop_database(spark, "life_db")
    assert not spark.catalog.databaseExists("life_db")


def data_files(path):
    return [
        os.path.join(folder, f)
        for folder, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    ]


def test_partitioned_table_with_one_big_site(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("site")
    )
    keyed = K.with_partition(df, F.col("site"))
    table = K.save_partitioned(keyed, "part_t", path=path)
    assert table.exceptAll(keyed.select(table.columns)).isEmpty() and table.count() == 3000
    one = keyed.filter("site = 'hot'").head().partition
    pruned = table.filter(F.col("partition") == one)
    assert "PartitionFilters: [isnotnull(partition#" in plan_of(pruned)
    assert pruned.filter("site = 'hot'").count() == 1000
    assert {r.partition for r in K.partitions_of(spark, "part_t").collect()} == {
        f"partition={r.partition}" for r in keyed.select("partition").distinct().collect()
    }
    detail = K.table_detail(table, "partition").collect()
    files = data_files(path)
    assert sum(r.num_files for r in detail) == len(files)
    assert sum(r.size_in_bytes for r in detail) == sum(os.path.getsize(f) for f in files)
    assert sum(r.num_rows for r in detail) == 3000
    assert K.table_detail(table).head().num_rows == 3000
    K.drop_table(spark, "part_t")


def test_big_partition_is_written_by_many_tasks_without_adaptive_execution(spark, tmp_path):
    df = spark.range(2000).withColumn("partition", F.lit("aa"))
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        K.save_partitioned(df, "salted_t", path=str(tmp_path / "s"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(data_files(str(tmp_path / "s"))) > 1
    K.drop_table(spark, "salted_t")


def test_detail_and_listing_agree(spark, tmp_path):
    df = spark.range(3000).select("id", (F.col("id") % 3).cast("string").alias("partition"))
    table = K.save_partitioned(df, "listed_table", path=str(tmp_path / "t"))
    detail = {r.partition: (r.num_files, r.size_in_bytes) for r in K.table_detail(table, "partition").collect()}
    listed = {r.partition: (r.num_files, r.size_in_bytes) for r in K.listed_files(spark, str(tmp_path / "t"), "partition").collect()}
    assert detail == listed and set(detail) == {"0", "1", "2"}
    on_disk = sum(f.stat().st_size for f in (tmp_path / "t").rglob("part-*"))
    assert K.listed_files(spark, str(tmp_path / "t")).first().size_in_bytes == on_disk


def test_only_wanted_partitions_are_read(spark, tmp_path):
    df = spark.range(2000).select("id", (F.col("id") % 40).cast("string").alias("site"))
    table = K.save_partitioned(K.with_partition(df, F.col("site")), "pruned_table", path=str(tmp_path / "p"))
    sites = spark.createDataFrame([("3", 1), ("17", 0), ("17", 1), ("99", 1)], "site string, wanted int").filter("wanted = 1")
    found = K.read_partitions_of(table, K.with_partition(sites.select("site"), F.col("site")), "partition", ["site"])
    assert "dynamicpruning" in plan_of(found)
    rows = found.collect()
    assert sorted(r.id for r in rows) == [i for i in range(2000) if i % 40 in (3, 17)]
    files = found.select(F.input_file_name()).distinct().count()
    assert files <= 2 < table.select(F.input_file_name()).distinct().count()


def test_table_detail_reads_no_column(spark, tiny):
    detail = K.table_detail(A.read_table(spark, tiny, "documents"))
    assert "ReadSchema: struct<>" in plan_of(detail)


def test_materialize_cuts_lineage(spark):
    out = K.materialize(spark.range(10).withColumn("x", F.lit("v")), "cut")
    assert out.count() == 10 and "Range" not in plan_of(out)
    assert K.shared_folder(spark) in out.inputFiles()[0]


class _Settings:
    """As much of a session as the folder rule looks at."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda k, *d: conf.get(k, *d))})


@pytest.mark.parametrize("master", ["local[4]", "spark://h:7077", "yarn"])
def test_the_folder_rule_is_the_same_for_every_master(master):
    both = {"spark.checkpoint.dir": "hdfs://c/shared/", "spark.sql.warehouse.dir": "hdfs://c/tables"}
    assert K.shared_folder(_Settings(master, **both)) == "hdfs://c/shared"
    both.pop("spark.checkpoint.dir")
    assert K.shared_folder(_Settings(master, **both)) == "hdfs://c/tables"


def test_shuffle_partitions():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 * 1024**3, 8) == 80
    assert shuffle_partitions(100 * 1024**4, 8) == 100 * 1024**4 // (128 * 1024**2)
