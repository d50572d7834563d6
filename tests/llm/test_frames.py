import pyarrow as pa
from pyspark.sql import functions as F

from pagewright.llm import frames


def test_slices_are_bounded_by_rows_and_bytes():
    small = pa.RecordBatch.from_arrays([pa.array(["x"] * 2500)], ["t"])
    assert [b.num_rows for b in frames.small_batches(iter([small]))] == [1000, 1000, 500]
    large = pa.RecordBatch.from_arrays([pa.array(["x" * (3 << 20)] * 10)], ["t"])
    sizes = [b.num_rows for b in frames.small_batches(iter([large]))]
    assert sum(sizes) == 10 and max(sizes) <= 2
    huge = pa.RecordBatch.from_arrays([pa.array(["x" * (20 << 20)])], ["t"])
    assert [b.num_rows for b in frames.small_batches(iter([huge]))] == [1]
    assert list(frames.small_batches(iter([small.slice(0, 0)]))) == []


def test_long_texts_come_few_at_a_time(spark):
    """Two hundred texts of a megabyte, in one partition, with Spark's own limits."""
    docs = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    found = frames.map_texts(docs, {"text": F.col("text")}, "rows long, bytes long", sizes).collect()
    assert sum(r.rows for r in found) == 200 and max(r.rows for r in found) <= 9


def test_settings_come_back_also_after_an_error(spark):
    names = [f"spark.sql.execution.arrow.{n}" for n in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(n) for n in names]
    try:
        with frames.short_batches(spark):
            assert spark.conf.get(names[0]) == "1000"
            raise KeyError
    except KeyError:
        pass
    frames.written(spark.range(3).toDF("x"), "some")
    assert [spark.conf.get(n) for n in names] == before
