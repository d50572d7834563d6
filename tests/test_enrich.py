import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from pagewright.functions import vectors as V
from pagewright.operators import arithmetic, embedding, enrich, skew
from pagewright.sources.tables import read_table


def test_one_call_per_distinct_content(spark, tmp_path):
    calls = str(tmp_path)

    def shout(value):
        import uuid

        open(f"{calls}/{value}-{uuid.uuid4().hex}", "w").close()
        if value == "bad":
            raise ValueError("no")
        return value.upper()

    rows = [(i, v) for i, v in enumerate(["a", "b", "a", "bad", None, "a", "bad"])]
    df = spark.createDataFrame(rows, "id int, text string").repartition(4)
    out = enrich.dedup_enrich(df, "text", shout, ["id"])
    got = {r.id: (r.result, r.error) for r in out.collect()}
    no = (None, "ValueError: no")
    assert got == {
        0: ("A", None), 1: ("B", None), 2: ("A", None), 3: no, 4: (None, None), 5: ("A", None), 6: no
    }
    assert sorted(f.split("-")[0] for f in os.listdir(calls)) == ["a", "b", "bad"]


def logged_calls(folder, fails):
    """A service that notes each call and fails for the contents in ``fails``."""

    def shout(value):
        import uuid

        open(f"{folder}/{value}-{uuid.uuid4().hex}", "w").close()
        if value in fails:
            raise ValueError("no")
        return value.upper()

    return shout


def calls_in(folder):
    return sorted(f.split("-")[0] for f in os.listdir(folder))


def test_a_second_run_calls_nothing_that_was_answered(spark, tmp_path):
    store, (one, two, three) = str(tmp_path / "store"), [tmp_path / n for n in ("one", "two", "three")]
    for folder in (one, two, three):
        folder.mkdir()
    rows = [(i, v) for i, v in enumerate(["a", "b", "a", "bad", None, "a", "bad", "worse"])]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    first = enrich.resume_enrich(df, "text", logged_calls(str(one), {"bad", "worse"}), ["id"], store, slices=3)
    no = (None, "ValueError: no", 1)
    assert {r.id: (r.result, r.error, r.attempts) for r in first.collect()} == {
        0: ("A", None, 1), 1: ("B", None, 1), 2: ("A", None, 1), 3: no, 4: (None, None, None), 5: ("A", None, 1), 6: no, 7: no
    }
    assert calls_in(one) == ["a", "b", "bad", "worse"]

    more = df.union(spark.createDataFrame([(8, "c"), (9, "b")], df.schema))
    second = enrich.resume_enrich(more, "text", logged_calls(str(two), {"worse"}), ["id"], store, retries=2)
    got = {r.id: (r.result, r.error, r.attempts) for r in second.collect()}
    assert got[3] == got[6] == ("BAD", None, 2) and got[7] == (None, "ValueError: no", 4)
    assert got[8] == ("C", None, 1) and got[9] == ("B", None, 1)
    assert calls_in(two) == ["bad", "c", "worse", "worse", "worse"]

    spared = df.filter("text <> 'worse'")
    third = enrich.resume_enrich(spared, "text", logged_calls(str(three), {"a"}), ["id"], store)
    assert sorted(r.result for r in third.collect()) == ["A", "A", "A", "B", "BAD", "BAD"]
    assert calls_in(three) == []


def test_slices_that_were_committed_are_kept_when_a_run_dies(spark, tmp_path, monkeypatch):
    store, calls = str(tmp_path / "store"), tmp_path / "calls"
    calls.mkdir()
    df = spark.createDataFrame([(i, f"t{i}") for i in range(40)], "id int, text string")
    real, seen = enrich.call_for_each, []

    def dies_in_the_third(*args):
        seen.append(1)
        if len(seen) == 3:
            raise RuntimeError("the run dies")
        return real(*args)

    monkeypatch.setattr(enrich, "call_for_each", dies_in_the_third)
    with pytest.raises(RuntimeError):
        enrich.resume_enrich(df, "text", logged_calls(str(calls), set()), ["id"], store, slices=4)
    done = len(calls_in(calls))
    assert 0 < done < 40
    out = enrich.resume_enrich(df, "text", logged_calls(str(calls), set()), ["id"], store, slices=4)
    assert sorted(r.result for r in out.collect()) == sorted(f"T{i}" for i in range(40))
    assert calls_in(calls) == sorted(f"t{i}" for i in range(40))


def test_no_row_is_lost_on_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id int, text string")
    assert enrich.resume_enrich(df, "text", enrich.word_counter(), ["id"], str(tmp_path / "s")).count() == 0


def test_hot_content_is_spread(spark):
    n = 9000
    df = spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("text")
    )
    out = enrich.dedup_enrich(df, "text", enrich.word_counter(), ["id"])
    assert out.count() == n and out.filter("result <> '1'").isEmpty()


def test_lookup_join_spreads_hot_rows(spark):
    """The rows of a hot key go to many salts and the join equals the plain one."""
    left = spark.range(8000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = skew.hot_keys(left, "k")
    assert [tuple(r) for r in hot.collect()] == [(0, 500)]
    joined = skew.lookup_join(left, right, ["k"], hot, ["id"])
    plain = left.join(right, "k", "left")
    assert joined.select("id", "k", "v").exceptAll(plain.select("id", "k", "v")).isEmpty()
    assert joined.count() == plain.count() == 8000


def test_lookup_join_on_two_columns_repeats_few_rows(spark):
    """A value of one column with many values of the other gets no salts; the join equals the plain one."""
    left = spark.range(6000).select(
        "id",
        F.when(F.col("id") % 100 != 0, 7).alias("k"),
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 101 != 0, F.col("id")).alias("j"),
    )
    keys = ["k", "j"]
    right = left.where("k is not null and j is not null").groupBy(*keys).agg(F.count("*").alias("n"))
    hot = skew.heavy_keys(right, keys, "n")
    assert [(r.k, r.j) for r in hot.collect()] == [(7, 0)]
    assert skew.salted_matches(right, keys, hot).count() < right.count() + 2 / skew.HOT_SHARE
    joined = skew.lookup_join(left, right, keys, hot).select("id", *keys, "n")
    plain = left.join(right, keys, "left").select("id", *keys, "n")
    assert joined.exceptAll(plain).isEmpty() and joined.count() == plain.count() == 6000


def test_hot_keys_are_few(spark):
    even = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    assert skew.hot_keys(even, "k").isEmpty()


def test_copies_follow_the_share_of_a_key(spark):
    """However many hot keys there are, their fan-outs add up to less than 2 / HOT_SHARE."""
    left = spark.range(20_000).select((F.col("id") % 900).alias("k"))
    skewed = left.union(spark.range(30_000).select(F.lit(0).alias("k")))
    for df, keys in ((left, 900), (skewed, 1)):
        fans = [r.fan_out for r in skew.hot_keys(df, "k").collect()]
        assert len(fans) == keys and sum(fans) < 2 / skew.HOT_SHARE
        assert min(fans) >= 1


def test_equal_rows_get_many_salts(spark):
    """Rows of a hot key that are equal in every column still spread over tasks."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(0, 4000, 1, 4).select(F.lit("u").alias("k"), F.lit("same").alias("x"))
        right = spark.createDataFrame([("u", 1)], "k string, v int").hint("merge")
        joined = skew.lookup_join(left, right, ["k"], skew.hot_keys(left, "k"))
        tasks = joined.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert joined.filter("v = 1").count() == 4000 and tasks > 1


def test_encoder_is_made_once_per_process(spark, tmp_path):
    made = str(tmp_path)

    def factory():
        import os
        import uuid

        open(f"{made}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
        df = spark.range(0, 200, 1, 40).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text"))
        out = embedding.embed_texts(df, output="v", factory=factory)
        lengths = sorted(r.v[0] for r in out.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert lengths == [float(i) for i in range(200)]
    processes = [name.split("-")[0] for name in os.listdir(made)]
    assert len(processes) == len(set(processes)) < 40


def test_default_encoder(spark):
    df = spark.createDataFrame([("the cat the",), ("",), (None,)], "text string")
    rows = [r.v for r in embedding.embed_texts(df, output="v").collect()]
    assert len(rows[0]) == 64 and abs(sum(x * x for x in rows[0]) - 1) < 1e-12
    assert rows[1] == [0.0] * 64 and rows[2] is None


def test_embedding_table_columns(spark):
    df = spark.createDataFrame([("p", 0, 0, "T", None, 0, "x")],
                               "path string, page int, section_index int, title string, "
                               "continuation boolean, text_index int, text string")
    assert embedding.embed_texts(df).columns == [
        "path", "page", "section_index", "continuation", "text_index", "text_bert_embeddings"
    ]


def test_cosine(spark):
    df = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, [0.0, 0.0]), (4, [-1.0, 0.0])],
        "id int, v array<double>",
    )
    scores = embedding.cosine_to_row(df, "id", "v", 0)
    assert dict(map(tuple, scores.collect())) == {1: 1.0, 2: 0.0, 3: None, 4: -1.0}
    assert "CartesianProduct" not in plan_of(scores) and "NestedLoop" not in plan_of(scores)


def test_pooling(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "v array<double>")
    row = df.select(V.cls_pool(V.reshape(F.col("v"), 2, 2)).alias("c")).head()
    assert row.c == [1.0, 2.0]
    empty = spark.createDataFrame([([],)], "h array<array<double>>")
    assert empty.select(V.cls_pool(F.col("h")).alias("c")).head().c is None


def test_price_parts(spark):
    df = spark.createDataFrame([(4.0, 2.5, 0.1), (1.0, 8.0, 0.0)], "q double, p double, d double")
    out = df.select(arithmetic.price_parts(F.col("q"), F.col("p"), F.col("d")).alias("parts"))
    assert out.schema["parts"].dataType.simpleString() == arithmetic.PARTS
    got = [[(p.kind, p.value) for p in r.parts] for r in out.collect()]
    assert got == [[("gross", 10.0), ("discount", 1.0), ("net", 9.0)], [("gross", 8.0), ("discount", 0.0), ("net", 8.0)]]


@pytest.mark.parametrize("name", ["lineitem"])
def test_multiply_reads_two_columns(spark, tiny, name):
    product = V.multiply(F.col("l_quantity"), F.col("l_extendedprice"))
    plan = plan_of(read_table(spark, tiny, name).select(product.alias("p")))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan
