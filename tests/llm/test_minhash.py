import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pagewright.llm import components, minhash

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def brute(docs, settings):
    """Classes by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    df = Counter(s for x in sets for s in x)
    least = max(settings.common_share * len(docs), 1)
    w = lambda s: 1 + math.log(len(docs) / df[s] if df[s] > least else 1 / settings.common_share)
    parent = list(range(len(docs)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if not a or not b:
                continue
            low = sum(min(a[s], b[s]) * w(s) for s in a.keys() & b.keys())
            high = sum(max(a[s], b[s]) * w(s) for s in a.keys() | b.keys())
            if a == b or (high and low / high >= settings.threshold):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = defaultdict(list)
    for k in range(len(docs)):
        groups[root(k)].append(docs[k][0])
    return sorted(tuple(sorted(g, key=str)) for g in groups.values())


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    docs, nxt = [], iter(range(1000))
    for _ in range(25):
        base = [word() for _ in range(r.randint(3, 150))]
        docs.append((next(nxt), " ".join(base)))
        for _ in range(r.choice([0, 0, 1, 6])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 5])):
                copy[r.randrange(len(copy))] = word()
            docs.append((next(nxt), "  ".join(copy).upper()))
    docs += [(900, "one"), (901, "One!"), (902, None), (903, ""), (904, "?!"), (905, "one two"), (905, "one two"), (906, docs[0][1])]
    return docs


def classes_of(rows):
    groups = defaultdict(list)
    alone = []
    for r in rows:
        if r.words_digest is None:
            alone.append((r.doc_id,))
        else:
            groups[r.class_id].append(r.doc_id)
    return sorted([*alone, *(tuple(sorted(g, key=str)) for g in groups.values())])


def test_classes_equal_brute_force(spark):
    docs = corpus(4)
    settings = minhash.Settings(common_share=0.03)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = minhash.near_duplicates(df, settings=settings).collect()
    assert len(rows) == len(docs)
    assert classes_of(rows) == brute(docs, settings)
    kept = minhash.keep_one(df, settings=settings).collect()
    wanted = {(r.class_id if r.words_digest else r.doc_id) for r in rows}
    assert sorted(r.doc_id for r in kept) == sorted(wanted)


def test_a_large_group_of_near_copies_is_one_class(spark):
    """A third of all documents differ from one text in a word each; two of three are unlike any."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(150)]
    docs = []
    for k in range(120):
        words = list(base) if k % 3 == 0 else [word() for _ in range(80)]
        words[r.randrange(len(words))] = word()
        docs.append((k, " ".join(words)))
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows if r.class_id == 0} == set(range(0, 120, 3))
    assert len({r.class_id for r in rows}) == 81


def test_texts_around_the_threshold_that_share_a_passage(spark):
    """Many texts that meet everywhere but are mostly not near, and a few links among them."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(70)]
    docs = []
    for k in range(60):
        own = [word() for _ in range(r.randint(15, 60))]
        docs.append((2 * k, " ".join(passage + own)))
        if k % 5 == 0:
            own[r.randrange(len(own))] = word()
            docs.append((2 * k + 1, " ".join(passage + own)))
    settings = minhash.Settings(common_share=0.9)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert classes_of(minhash.near_duplicates(df, settings=settings).collect()) == brute(docs, settings)


def test_awkward_rows_and_empty_table(spark, check_s_like):
    rows = minhash.near_duplicates(check_s_like).collect()
    assert len(rows) == 10
    assert {r.class_id for r in rows if r.doc_id in (1, 2)} == {1}
    kept = minhash.keep_one(check_s_like)
    assert kept.columns == check_s_like.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "5", "None", "6", "7", "8"])
    assert minhash.near_duplicates(check_s_like.limit(0)).count() == 0
    assert minhash.keep_one(check_s_like.limit(0)).count() == 0


def test_sample_agreement_estimates_weighted_jaccard():
    r = np.random.default_rng(1)
    items = np.unique(r.integers(0, 1 << 62, 120).astype(np.uint64))
    a, b = items[:100], items[20:]
    wa, wb = r.uniform(0.5, 9, len(a)), r.uniform(0.5, 9, len(b))
    wb[: len(a) - 20] = wa[20:] * r.choice([1.0, 1.5], len(a) - 20)
    x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    every = x.keys() | y.keys()
    exact = sum(min(x.get(k, 0), y.get(k, 0)) for k in every) / sum(max(x.get(k, 0), y.get(k, 0)) for k in every)
    names = minhash.weighted_samples(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, len(a)]), 4000)
    assert abs((names[0] == names[1]).mean() - exact) < 0.03


def test_components_of_chains_and_stars(spark):
    links = [(f"c{i:02}", f"c{i + 1:02}") for i in range(30)] + [("s0", f"s{i}") for i in range(1, 9)] + [("x", "x")]
    found = components.components(spark.createDataFrame(links, "a string, b string"))
    roots = {r.node: r.root for r in found.collect()}
    assert {roots[f"c{i:02}"] for i in range(31)} == {"c00"} and {roots[f"s{i}"] for i in range(9)} == {"s0"}
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("copies", [20, 300])
def test_copies_near_their_original_but_not_each_other(spark, copies):
    """One original and copies with a run of words replaced: 0.81 to 0.88 from it, less from each other."""
    r = random.Random(copies)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(150)]
    docs = [(0, " ".join(base))]
    for k in range(1, copies + 1):
        words, n = list(base), r.randint(6, 11)
        at = r.randrange(len(words) - n)
        words[at : at + n] = [word() for _ in range(n)]
        docs.append((k, " ".join(words)))
    docs += [(1000 + k, " ".join(word() for _ in range(80))) for k in range(9 * copies if copies < 50 else 100)]
    settings = minhash.Settings(common_share=0.99)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert classes_of(minhash.near_duplicates(df, settings=settings).collect()) == brute(docs, settings)


def test_links_in_cells_equal_brute_force(spark, monkeypatch):
    """Groups of many cells, with cells of one component and without."""
    monkeypatch.setattr(minhash, "CELL_ROWS", 8)
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    docs = []
    for _ in range(4):
        base = [word() for _ in range(120)]
        for _ in range(40):
            words, n = list(base), r.randint(0, 12)
            at = r.randrange(len(words) - n)
            words[at : at + n] = [word() for _ in range(n)]
            docs.append((len(docs), " ".join(words + base[:5] * r.choice([0, 0, 1, 6]))))
    settings = minhash.Settings(common_share=0.99)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert classes_of(minhash.near_duplicates(df, settings=settings).collect()) == brute(docs, settings)


def test_shared_weights_equal_brute_force():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 60, 40).astype(np.uint64)) for _ in range(50)]
    sets = [(found, r.integers(1, 4, len(found))) for found in sets]
    idf = minhash.Idf(2.0, np.arange(5, dtype=np.uint64), np.array([0.0, 0.5, 1.0, 1.5, 0.1]))
    for k, shared in minhash._shared_weights(sets, idf):
        for j, got in enumerate(shared, k + 1):
            a, b = (dict(zip(f.tolist(), c.tolist())) for f, c in (sets[k], sets[j]))
            want = sum(min(n, b[s]) * idf.of(np.array([s], np.uint64))[0] for s, n in a.items() if s in b)
            assert abs(got - want) < 1e-3


def test_boilerplate_of_a_twentieth_of_the_documents_does_not_make_texts_near(spark):
    """Texts of which 90 % is boilerplate held by 5 % of the documents, with production parameters."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    boilerplate = [word() for _ in range(184)]
    docs = [(k, " ".join(boilerplate + [word() for _ in range(20)])) for k in range(10)]
    docs += [(k, " ".join(word() for _ in range(20))) for k in range(10, 200)]
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(row.class_id == row.doc_id for row in rows)
