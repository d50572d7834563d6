import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from pagewright.operators import packing as P


def fold(lengths, budget):
    """Chunk of each length."""
    out, total, chunk = [], None, -1
    for n in lengths:
        if total is None or total + n >= budget:
            chunk, total = chunk + 1, n
        else:
            total += n
        out.append(chunk)
    return out


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 12), min_size=1, max_size=9), min_size=1, max_size=7),
    st.integers(0, 20),
    st.integers(0, 40),
)
def test_functions_say_what_the_walk_does(blocks, budget, open_length):
    runs = [P.block_jumps(np.array(b, np.int64), budget) for b in blocks]
    total, opened = open_length, 0
    for b in blocks:
        for n in b:
            if total + n >= budget:
                total, opened = n, opened + 1
            else:
                total += n
    one_by_one, length = 0, open_length
    for run in runs:
        more, length = run.after(length, budget)
        one_by_one += more
    assert (one_by_one, length) == (opened, total)
    assert P.composed(runs, budget).after(open_length, budget) == (opened, total)
    middle = len(runs) // 2
    if middle:
        halves = [P.composed(runs[:middle], budget), P.composed(runs[middle:], budget)]
        assert P.composed(halves, budget).after(open_length, budget) == (opened, total)


def test_steps_stay_within_a_budget():
    jumps = P.block_jumps(np.full(4096, 7, np.int64), 100)
    assert len(jumps.reach) == 15
    whole = P.composed([jumps] * 50, 100)
    assert len(whole.reach) == 15 and whole.total == 50 * 4096 * 7


@pytest.mark.parametrize(("block_bits", "fan_bits", "budget"), [(2, 3, 20), (12, 10, 33), (4, 2, 0)])
def test_equals_the_fold(spark, block_bits, fan_bits, budget):
    r = random.Random(block_bits * 100 + budget)
    want, rows = {}, []
    for key in ("a", "b", "c", None):
        places = sorted(r.sample(range(-300, 300), r.choice([1, 5, 90])))
        lengths = [r.choice([0, 1, 3, 8, 25]) for _ in places]
        want |= {(key, p): c for p, c in zip(places, fold(lengths, budget), strict=True)}
        rows += [(key, p, n, f"{key}{p}") for p, n in zip(places, lengths, strict=True)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, p int, n int, note string").repartition(5)
    out = P.pack_rows(df, "k", "p", "n", budget, block_bits, fan_bits)
    assert out.columns == ["k", "p", "n", "note", "chunk_index"]
    got = out.collect()
    assert {(x.k, x.p): x.chunk_index for x in got} == want
    assert sorted((x[:4] for x in map(tuple, got)), key=str) == sorted(rows, key=str)


def test_a_million_segments_of_one_key_over_many_tasks(spark):
    n, budget = 1_000_000, 400
    df = spark.range(0, n, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("p"), F.pmod(F.xxhash64("id"), F.lit(61)).alias("n"))
    out = P.pack_rows(df, "k", "p", "n", budget)
    rows = out.select("p", "n", "chunk_index").toArrow().sort_by("p")
    assert rows.column("chunk_index").to_pylist() == fold(rows.column("n").to_pylist(), budget)
    tasks = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(t["count"] for t in tasks) < n
    assert "Window" not in plan_of(out)


def test_ties_nulls_and_empty_tables(spark):
    rows = [("a", 5, 4), ("a", 5, 7), ("a", None, 9), ("a", None, None), ("a", 1, None), ("a", 2, 12), ("a", 3, -5)]
    df = spark.createDataFrame(rows, "k string, p long, n long")
    got = P.pack_rows(df.repartition(3), "k", "p", "n", 10).collect()
    # In order: null 0, null 9, 1: 0, 2: 12, 3: -5 as 0, 5: 4, 5: 7.
    assert sorted((x.chunk_index, x.p is not None, x.p or 0, x.n or 0) for x in got) == [
        (0, False, 0, 0), (0, False, 0, 9), (0, True, 1, 0), (1, True, 2, 12), (2, True, 3, -5), (2, True, 5, 4), (3, True, 5, 7)
    ]
    assert P.pack_rows(df.limit(0), "k", "p", "n", 10).count() == 0
    with pytest.raises(ValueError):
        P.pack_rows(df, "k", "p", "n", -1)


def test_texts_and_timed_segments(spark):
    texts = spark.createDataFrame([("a", 2, "two"), ("a", 0, "zero"), ("a", 1, None), ("a", 3, "three")], "k string, p int, t string")
    got = P.pack_texts(texts, "k", "p", "t", 8).orderBy("chunk_index").collect()
    assert [tuple(x) for x in got] == [("a", 0, "zero\ntwo", 7, 3), ("a", 1, "three", 5, 1)]
    timed = spark.createDataFrame([("a", 0, 10, 15), ("a", 1, 20, 24), ("a", 2, 30, 31)], "k string, p int, s long, e long")
    got = P.pack_timed(timed, "k", "p", "s", "e", 10).orderBy("chunk_index").collect()
    assert [tuple(x) for x in got] == [("a", 0, 2, 9, 10, 24), ("a", 1, 1, 1, 30, 31)]
