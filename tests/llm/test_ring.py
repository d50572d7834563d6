import zlib
from collections import Counter

import pytest

from pagewright.llm import ring


def check(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_documents_with_awkward_rows(spark, check_s_like):
    rows = ring.shard_documents(check_s_like).collect()
    check(rows, 16)
    texts = {r.doc_id: r.text for r in check_s_like.collect()}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    assert ring.shard_documents(check_s_like.limit(0)).count() == 0


@pytest.mark.parametrize("shards", [1, 7, 16])
def test_hot_key_and_small_cells(spark, shards):
    hot = [(1, k % 3) for k in range(900)]
    rows = spark.createDataFrame(hot + [(k, 0) for k in range(2, 1500)], "doc_id long, size long").repartition(5)
    got = ring.ring_shards(rows, "doc_id", shards, points=8, cell_rows=3).collect()
    check(got, shards)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter(hot + [(k, 0) for k in range(2, 1500)])


def test_same_rows_same_shards_whatever_the_layout(spark):
    rows = spark.range(3000).withColumnRenamed("id", "doc_id")
    one = {r.doc_id: (r.shard, r.slot) for r in ring.ring_shards(rows.repartition(3), "doc_id", 16).collect()}
    two = {r.doc_id: (r.shard, r.slot) for r in ring.ring_shards(rows.repartition(11), "doc_id", 16).collect()}
    assert one == two


def test_most_rows_stay_home_and_few_move_when_a_shard_is_added(spark):
    rows = spark.range(20000).withColumnRenamed("id", "doc_id")
    before = ring.ring_shards(rows, "doc_id", 16).collect()
    after = {r.doc_id: r.shard for r in ring.ring_shards(rows, "doc_id", 17).collect()}
    assert sum(r.shard == r.home for r in before) > 0.9 * 20000
    assert sum(r.shard != after[r.doc_id] for r in before) < 0.2 * 20000


def test_fill_follows_the_ring():
    owners, totals = [0, 1, 0, 2], [5, 1, 2, 1]
    pieces = ring.fill(owners, totals, 3)
    assert pieces[0] == [(0, 0, 0, 0), (3, 1, 1, 1)]
    assert pieces[2] == [(0, 2, 1, 1)]


@pytest.mark.parametrize(("shards", "points"), [(5, 4), (16, 256)])
def test_shards_equal_a_plain_walk_around_the_ring(spark, shards, points):
    """Row by row: first all rows that fit at home, arc by arc, then the others clockwise."""
    import hashlib

    from pyspark.sql import functions as F

    rows = spark.range(700).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), "id").repartition(3)
    got = ring.ring_shards(rows, "doc_id", shards, points=points, cell_rows=5).collect()
    positions = {r.doc_id: r.p for r in rows.select("doc_id", F.xxhash64("doc_id").bitwiseAND(F.lit(0xFFFFFFFF)).alias("p")).distinct().collect()}
    placed = {}
    for s in range(shards):
        for k in range(points):
            placed.setdefault(int.from_bytes(hashlib.blake2b(f"{s}/{k}".encode(), digest_size=4).digest(), "big"), s)
    ends = sorted(placed)
    arc_of = lambda p: next((k for k, e in enumerate(ends) if e >= p), 0)
    arcs = [0] * len(ends)
    for r in got:
        arcs[arc_of(positions[r.doc_id])] += 1
        assert r.home == placed[ends[arc_of(positions[r.doc_id])]]
    room = [len(got) // shards + (s < len(got) % shards) for s in range(shards)]
    want = Counter()
    left = []
    for arc, n in enumerate(arcs):
        for _ in range(n):
            home = placed[ends[arc]]
            if room[home]:
                room[home] -= 1
                want[(arc, home)] += 1
            else:
                left.append(arc)
    for arc in left:
        step = arc
        while not room[placed[ends[step]]]:
            step = (step + 1) % len(ends)
        room[placed[ends[step]]] -= 1
        want[(arc, placed[ends[step]])] += 1
    assert Counter((arc_of(positions[r.doc_id]), r.shard) for r in got) == want
    check(got, shards)


def test_a_hot_arc_gets_cells_in_proportion(spark, monkeypatch):
    """Rows of one key that differ in other columns are ranked in many small windows."""
    kept = {}
    written = ring.written

    def noted(df, label):
        kept[label] = written(df, label)
        return kept[label]

    monkeypatch.setattr(ring, "written", noted)
    rows = spark.range(6000).selectExpr("if(id % 2 = 0, 5, id) as doc_id", "id as size")
    check(ring.ring_shards(rows, "doc_id", 16, points=16, cell_rows=50).collect(), 16)
    assert max(r.n for r in kept["ring-cells"].collect()) < 3 * 50
