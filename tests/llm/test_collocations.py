import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pagewright.llm import collocations
from pagewright.llm.collocations import Settings


def counted(docs, longest):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[p : p + k]) for p in range(len(words) - k + 1))
    return f, n


def brute(docs, settings):
    f, n = counted(docs, settings.longest)
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= settings.least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= settings.within * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(rows)[: settings.most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus(seed, size=300):
    r = random.Random(seed)
    words = ["the", "of", "New", "york", "CITY", "é", "Ünd", "x y", " ", "a-b", "#", "12", "日本"] + ["w%d" % k for k in range(20)]
    docs = []
    for _ in range(size):
        lang = r.choice(["en", "en", "en", "fr", None, "und", "x\ny"])
        text = "".join(r.choices(words, [9, 7] + [2] * 11 + [1] * 20)[0] + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "?! ", "\r\n"]) for _ in range(r.randint(0, 60)))
        docs.append((text, lang))
    return docs + [(None, "en"), ("", None), (" .. ", "fr"), ("hot pair here " * 400, "en"), docs[0], docs[0]]


def frame(spark, docs):
    return spark.createDataFrame(docs, "text string, lang string").repartition(4)


@pytest.mark.parametrize(
    ("seed", "settings"),
    [
        (1, Settings()),
        (2, Settings(least=3, budget=50)),  # prefixes are extended to full depth, and beyond the budget there
        (3, Settings(least=4, budget=1000, most=7)),
        (4, Settings(least=2, longest=2, within=100)),
    ],
)
def test_equals_brute_force(spark, seed, settings):
    docs = corpus(seed)
    got = collocations.collocations(frame(spark, docs), settings=settings)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(docs, settings)


def test_all_counts_are_leaf_totals(spark):
    docs = corpus(5)
    for budget in (1, 400):
        counts, words = collocations.phrase_counts(frame(spark, docs), "text", "lang", Settings(least=1, budget=budget))
        f, n = counted(docs, 3)
        got = {(r.lang, r.phrase): r.f for r in counts.collect()}
        assert counts.count() == len(got)
        assert got == {(lang, " ".join(p)): a for lang, found in f.items() for p, a in found.items()}
        assert {r.lang: r.n for r in words.collect()} == dict(n)


def test_groups_keep_to_the_budget():
    r = np.random.default_rng(1)
    totals = r.integers(0, 60, (1, 500))
    totals[0, 77] = 1000
    entries = collocations._planned(totals, 100, False, [])
    assert entries[0, 77] == -2 and (entries[0] >= 0).sum() == 499
    sums = np.bincount(entries[entries >= 0], totals[entries >= 0])
    assert sums.max() <= 100 and (sums[:-1] + sums[1:]).min() > 60


def test_small_slices_and_little_room_give_the_same(monkeypatch):
    docs = corpus(6)
    rows = [(t, "und" if x is None else x) for t, x in docs]
    def leaves():
        suffixes, found = collocations.Suffixes(3), Counter()

        def take():
            for part in suffixes.leaves():
                for path, n in zip(part.codes.tolist(), part.counts.tolist(), strict=True):
                    found[(part.lang, *(part.words[k] for k in path))] += n

        for _ in suffixes.add(pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([x for _, x in rows])], ["text", "lang"])):
            take()
        take()
        return found

    want = leaves()
    for name, value in (("SLICE", 7), ("HELD", 50), ("HELD_WORDS", 20)):
        monkeypatch.setattr(collocations, name, value)
        assert leaves() == want


def test_large_counts_stay_exact(spark):
    a = 3_000_000_000_000
    counts = spark.createDataFrame([("en", 1, "x", a + 1), ("en", 1, "y", a + 7), ("en", 2, "x y", a)], "lang string, depth int, phrase string, f long")
    words = spark.createDataFrame([("en", 10 * a)], "lang string, n long")
    original = collocations.phrase_counts
    collocations.phrase_counts = lambda *_: (counts, words)
    try:
        row = collocations.collocations(counts).first()
    finally:
        collocations.phrase_counts = original
    assert tuple(row) == ("en", 1, "x y", a, a + 1, a + 7, 10 * a, 1000000 * a * a // ((a + 1) * (a + 7)))


def test_awkward_rows_and_empty_tables(spark, check_s_like):
    rows = [(r.text, r.lang) for r in check_s_like.select("text", "lang").collect()]
    assert sorted(map(tuple, collocations.collocations(check_s_like).collect())) == brute(rows, Settings())
    assert collocations.collocations(check_s_like.limit(0)).count() == 0
