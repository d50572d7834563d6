import hashlib
import random

import numpy as np
import pytest

from pagewright.llm import suffixes


def brute(docs, length):
    seen = {}
    raws = [(i, (t or "").encode()) for i, t in docs]
    for k, (_, raw) in enumerate(raws):
        for p in range(len(raw) - length + 1):
            seen.setdefault(raw[p : p + length], []).append((k, p))
    gone = [np.zeros(len(raw), bool) for _, raw in raws]
    for at in seen.values():
        if len(at) > 1:
            for k, p in at:
                gone[k][p : p + length] = True
    out = []
    for (i, raw), mask in zip(raws, gone, strict=True):
        rest = bytes(b for b, m in zip(raw, mask, strict=True) if not m)
        spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        out.append((i, len(raw), int(mask.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def sample(seed, length):
    """Texts with copies, edits, shared passages of about the least length, periods and umlauts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, passage = prose(60), prose(200).encode()[: length + 3].decode("utf-8", "ignore")
    docs = [(i, prose(r.randint(0, 60))) for i in range(12)]
    docs += [(20 + i, base) for i in range(3)]
    for i in range(12):
        at = r.randint(0, len(base))
        docs.append((30 + i, base[:at] + "#" + base[at + r.randint(0, 2) :]))
        docs.append((50 + i, prose(5) + passage[r.randint(0, 3) : len(passage) - r.randint(0, 3)] + prose(7)))
    docs += [(70, "ab" * length), (71, "x" * (length + 5)), (72, "x" * length), (73, "y" * length), (74, "z" * (length - 1))]
    docs += [(75, None), (75, ""), (None, base), (76, docs[0][1]), (76, docs[0][1]), (76, docs[1][1])]
    return docs


@pytest.mark.parametrize("length", [8, 110, 400])
def test_equals_brute_force(spark, length):
    docs = sample(length, length)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = suffixes.repeat_report(df, length=length).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, length)


def test_many_buckets_give_the_same(spark):
    docs = sample(1, 40)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = suffixes.repeat_report(df, length=40).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(tuple, got), key=str) == brute(docs, 40)


def test_awkward_and_empty_tables(spark, check_s_like):
    rows = {(r.doc_id, r.n_bytes): r for r in suffixes.repeat_report(check_s_like).collect()}
    assert rows[(6, 300000)].n_removed == 300000 and rows[(3, 0)].n_spans == 0
    assert suffixes.repeat_report(check_s_like).count() == 10
    assert suffixes.repeat_report(check_s_like.limit(0)).count() == 0


def test_multikey_quicksort_orders_by_all_tokens():
    r = np.random.default_rng(5)
    tokens = [r.integers(0, 4, 9000), r.integers(0, 50, 9000), r.integers(0, 9, 9000)]
    order = suffixes.multikey_quicksort(tokens)
    rows = list(zip(*(t[order].tolist() for t in tokens), strict=True))
    assert rows == sorted(rows) and sorted(order.tolist()) == list(range(9000))
