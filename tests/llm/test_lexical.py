import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pagewright.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, most=10):
    tfs = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in tfs if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        rows = []
        for i, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            score = 0
            for t in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                rows.append((-score, i is None, i if i is not None else 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(rows)[:most], 1)]
    return sorted(out, key=str)


def corpus(seed, size=400):
    r = random.Random(seed)
    words = ["The", "of", "and", "é", "naïve", "x1", "日本", "it's"] + ["w%d" % k for k in range(60)]
    weights = [40, 30, 20, 3, 2, 2, 2, 2] + [1 + k % 7 for k in range(60)]
    prose = lambda n: r.choice([" ", ", ", "\n"]).join(r.choices(words, weights, k=n))
    docs = [(k, prose(r.choice([0, 1, 3, 10, 40, 200]))) for k in range(size)]
    docs += [(900 + k, docs[k % 5][1]) for k in range(40)] + [(950, "THE"), (950, "the"), (951, None), (None, docs[3][1]), (None, "w1"), (7, docs[3][1])]
    items = [(k, prose(r.randint(1, 30))) for k in range(12)] + [(50, docs[3][1]), (51, None), (52, "?!"), (53, "unseen"), (54, "the THE the"), (54, "w1 unseen"), (None, "w2")]
    r.shuffle(docs)
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize(("seed", "most", "block"), [(1, 10, 4 << 20), (2, 3, 300), (3, 1, 600), (4, 1000, 4 << 20)])
def test_equals_brute_force(spark, seed, most, block):
    docs, items = corpus(seed)
    got = lexical.search(*frames(spark, docs, items), most=most, block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, most)


def test_reading_stops_early_and_leaves_nothing_out(monkeypatch):
    """Against full sums, with ties; a rare term with great impacts ends the reading of common lists."""
    r = np.random.default_rng(3)
    monkeypatch.setattr(lexical, "FIRST_STEP", 8)
    stopped = 0
    for _ in range(200):
        size, n_terms = int(r.integers(1, 300)), int(r.integers(1, 6))
        table = r.integers(0, r.choice([3, 50, 10**6]), (n_terms + 1, size)) * (r.random((n_terms + 1, size)) < r.choice([0.05, 0.5, 1.0]))
        table[0] = 0
        if n_terms > 1 and r.random() < 0.5:
            table[1] *= 1000 * (r.random(size) < 0.05)
        t, d = np.nonzero(table)
        index = lexical.ImpactIndex.of(t, d, table[t, d], n_terms + 1, size)
        most, bar = int(r.integers(1, 12)), int(r.choice([1, 1, 100]))
        rows, scores, read = index.nra(np.arange(1, n_terms + 1), most, bar)
        stopped += read < len(t)
        sums = table.sum(0)
        assert (sums[rows] == scores).all() and len(set(rows.tolist())) == len(rows)
        threshold = max(bar, int(np.sort(sums)[::-1][most - 1]) if size >= most else bar)
        assert set(np.flatnonzero(sums >= threshold)) <= set(rows.tolist())
    assert stopped > 20


def test_long_documents_do_not_overflow():
    lengths = np.array([5, 10**9])
    assert lexical.length_factors(lengths, 10**12, 10**13).tolist() == [10 + 90 * 5 * 10**12 // 10**13, 10 + 90 * 10**9 * 10**12 // 10**13]


def test_awkward_rows_and_empty_tables(spark, check_s_like):
    docs = [(r.doc_id, r.text) for r in check_s_like.select("doc_id", "text").collect()]
    items = [(1, "the quick word"), (2, None), (3, "École a null")]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, lexical.search(check_s_like, table).collect()), key=str) == brute(docs, items)
    assert lexical.search(check_s_like.limit(0), table).count() == 0
    assert lexical.search(check_s_like, table.limit(0)).count() == 0
