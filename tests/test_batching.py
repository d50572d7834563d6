import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import plan_of
from pagewright.operators import arithmetic, batching, embedding


def texts(spark, n=500):
    r = random.Random(4)
    rows = [(k, " ".join(r.choice(["a", "bb", "Ccc"]) for _ in range(r.choice([0, 1, 3, 9, 40, 90])))) for k in range(n)]
    rows += [(n, None), (n + 1, "?!")]
    return rows, spark.createDataFrame(rows, "id long, text string").repartition(6)


def model(rows, batch_rows, most):
    """(id, batch, tokens, longest) by one global sort."""
    cut = sorted((len((t or "").replace("?!", "").split()[:most]), i) for i, t in rows)
    words = {i: (t or "").replace("?!", "").lower().split()[:most] for i, t in rows}
    out = {}
    for at in range(0, len(cut), batch_rows):
        part = cut[at : at + batch_rows]
        for n, i in part:
            out[i] = (at // batch_rows, n, words[i] + ["[PAD]"] * (part[-1][0] - n))
    return out


def test_batches_are_padded_to_their_longest(spark):
    rows, df = texts(spark)
    got = batching.padded_batches(df, ["id"], batch_rows=32, model_tokens=50)
    assert got.columns == ["id", "batch", "n_tokens", "padded_length", "tokens"]
    found = got.collect()
    assert {r.id: (r.batch, r.n_tokens, r.tokens) for r in found} == model(rows, 32, 50)
    assert all(len(r.tokens) == r.padded_length <= 50 for r in found)
    plan = plan_of(got)
    assert "Window" not in plan and "SinglePartition" not in plan

    # The same texts padded as they arrive.
    in_order = [min(50, len((t or "").split())) for _, t in sorted(rows)]
    arrival = sum(32 * max(part) - sum(part) for part in (in_order[k : k + 32] for k in range(0, len(in_order), 32)))
    assert sum(r.padded_length - r.n_tokens for r in found) < 0.1 * arrival


def test_a_length_that_all_texts_have_is_spread_over_tasks(spark):
    df = spark.range(20_000).select("id", F.lit("one two three").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        batches = batching.length_batches(df, ["id"]).withColumn("file", F.input_file_name())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = batches.select("id", "batch", "file").collect()
    assert {r.id: r.batch for r in rows} == {i: i // 32 for i in range(20_000)}
    assert len({r.file for r in rows}) > 1


def test_numbers_follow_the_order(spark):
    df = spark.range(5000).select((F.xxhash64("id") % 700).alias("a"), "id").repartition(7)
    rows = batching.numbered(df, ["a", "id"], "n").collect()
    ordered = sorted(rows, key=lambda r: (r.a, r.id))
    assert [r.n for r in ordered] == list(range(5000))
    assert batching.numbered(df.limit(0), ["a"], "n").count() == 0


def test_the_encoder_sees_one_batch_at_a_time(spark):
    rows, df = texts(spark, 100)

    def factory():
        return lambda group: [[float(len(group)), float(len(t))] for t in group]

    out = batching.embed_batches(df, ["id"], batch_rows=16, model_tokens=1000, factory=factory)
    sizes = {i: len(t) for i, t in rows if t is not None}
    found = {r.id: r.vector for r in out.collect()}
    assert found.pop(100) is None
    assert all(0 < v[0] <= 16 and v[1] == sizes[i] for i, v in found.items()) and len(found) == len(sizes)
    plain = {r.id: r.v for r in embedding.embed_texts(df, output="v").collect()}
    assert {r.id: r.vector for r in batching.embed_batches(df, ["id"]).collect()} == plain


def test_empty_tables(spark):
    _, df = texts(spark, 3)
    assert batching.padded_batches(df.limit(0), ["id"]).count() == 0
    assert batching.embed_batches(df.limit(0), ["id"]).count() == 0


def test_parts_are_built_from_offsets():
    parts = arithmetic.named_parts({"a": pa.array([1.0, None, 3.0]), "b": pa.array(np.array([4.0, 5.0, 6.0]))})
    assert parts.to_pylist() == [[{"kind": "a", "value": x}, {"kind": "b", "value": y}] for x, y in ((1.0, 4.0), (None, 5.0), (3.0, 6.0))]
    assert arithmetic.named_parts({"a": pa.array([], pa.float64())}).to_pylist() == []


def test_arrow_functions_keep_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 3.0, 4.0)], "id int, a double, b double")
    rows = df.select("id", arithmetic.multiply_batches(F.col("a"), F.col("b")).alias("p"), arithmetic.price_parts(F.col("a"), F.col("a"), F.col("b")).alias("x"))
    got = {r.id: (r.p, [p.value for p in r.x]) for r in rows.collect()}
    assert got == {1: (None, [4.0, None, None]), 2: (12.0, [9.0, 36.0, -27.0])}
    assert "ArrowEvalPython" in plan_of(rows)
