import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pagewright.llm import debruijn
from pagewright.operators import skew

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window):
    texts = [(i, WORD.findall(t or "")) for i, t in docs]
    first = {}
    for i, words in texts:
        if i is not None:
            for p in range(len(words) - window + 1):
                key = tuple(words[p : p + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in texts:
        gone = [False] * len(words)
        if i is not None:
            for p in range(len(words) - window + 1):
                if first[tuple(words[p : p + window])] < i:
                    gone[p : p + window] = [True] * window
        rest = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, window):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abéD.") for _ in range(r.randint(1, 5)))
    prose = lambda n: [word() for _ in range(n)]
    base, passage = prose(8 * window), prose(3 * window)
    docs = [(k, prose(r.randint(0, 6 * window))) for k in range(12)]
    docs += [(20 + k, base) for k in range(4)]
    for k in range(20):
        edited = list(base)
        edited[r.randrange(len(edited))] = "#"
        a, b = sorted(r.sample(range(len(passage)), 2))
        docs += [(30 + k, edited), (60 + k, prose(5) + passage[a:b] + prose(3) + base[a : a + r.randint(0, 2 * window)])]
        docs.append((90 + k, prose(2) + passage + (prose(4) if k % 2 else passage) + prose(1)))
    docs += [(120, ["x"] * 3 * window), (121, ["x"] * (window + 3)), (122, ["a", "b"] * window), (123, ["b", "a"] * window), (124, ["y"] * 4 * window)]
    lines = [(i, r.choice([" ", "\n", "\t \r\n"]).join(w)) for i, w in docs]
    r.shuffle(lines)
    return lines + [(130, None), (131, ""), (None, " ".join(base)), (None, None), (5, lines[0][1]), (5, lines[0][1]), (3, lines[0][1]), (3, lines[1][1])]


@pytest.mark.parametrize(("seed", "window"), [(1, 50), (2, 8), (3, 5), (4, 1)])
def test_equals_brute_force(spark, seed, window):
    docs = corpus(seed, window)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = debruijn.span_report(df, window=window).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, window)


def test_strong_hashes_take_over_where_quick_ones_are_equal(spark, monkeypatch):
    docs = corpus(5, 8)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    seen, quick = [], debruijn._removed

    def collides_first(*args):
        seen.append(args[-1])
        found = quick(*args)
        wrong = F.transform("proofs", lambda p: p.withField("one", F.xxhash64("doc_id")))
        return found.withColumn("proofs", wrong) if args[-1] == 0 else found

    monkeypatch.setattr(debruijn, "_removed", collides_first)
    got = debruijn.span_report(df, window=8).collect()
    assert seen == [0, 1] and sorted(map(tuple, got), key=str) == brute(docs, 8)


def test_copies_are_compacted_to_one_path(spark):
    r = random.Random(6)
    base = " ".join("".join(r.choice("abcdef") for _ in range(5)) for _ in range(3000))
    df = spark.createDataFrame([(k, base) for k in range(40)], "doc_id long, text string").repartition(4)
    paths = debruijn._paths(debruijn._texts(df, "doc_id", "text"), 50, 0)
    assert [tuple(x) for x in paths.select("start", "end", "source").distinct().collect()] == [(0, 3000, 0)]
    rows = debruijn.remove_spans(df).orderBy("doc_id").collect()
    assert rows[0].kept == base and rows[0].copies == []
    assert all(x.kept == "" and [tuple(c) for c in x.copies] == [(0, 3000, 0)] for x in rows[1:])


def test_a_passage_in_many_surroundings_is_not_repeated_for_each(spark, monkeypatch):
    r = random.Random(7)
    prose = lambda n: ["".join(r.choice("abcdef") for _ in range(6)) for _ in range(n)]
    passage = prose(60)
    docs = [(k, " ".join(prose(55) + passage + prose(55))) for k in range(150)]
    made, salted = [], skew.salted_matches

    def counted(right, *args):
        out = salted(right, *args)
        made.append(out.count() - right.count())
        return out

    monkeypatch.setattr(skew, "salted_matches", counted)
    got = debruijn.span_report(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, 50)
    assert made and max(made) < 2 / skew.HOT_SHARE


def test_branches_end_paths(spark):
    graph = [("A", "B", 2), ("B", "C", 2), ("C", None, 2), ("D", "E", 3), ("E", "F", 2), ("F", None, 2), ("G", None, 5)]
    rows = [(ord(a), ord(a), 1, n, 2, b and ord(b), b and ord(b)) for a, b, n in graph]
    schema = "core long, edge long, source long, n long, size long, next_core long, next_edge long"
    found = debruijn.compacted(spark.createDataFrame(rows, schema)).collect()
    assert sorted((chr(x.core), x.size) for x in found) == [("A", 6), ("D", 2), ("E", 4), ("G", 2)]


def test_long_chains_have_their_whole_length(spark):
    rows = [(c * 100 + k, 7, c, 2, k + 1, None if k == n - 1 else c * 100 + k + 1, None) for c, n in ((1, 1), (2, 2), (3, 7), (4, 8), (5, 37)) for k in range(n)]
    schema = "core long, edge long, source long, n long, size long, next_core long, next_edge long"
    graph = spark.createDataFrame(rows, schema).withColumn("next_edge", F.when(F.col("next_core").isNotNull(), 7))
    found = debruijn.compacted(graph.select(*(F.col(c).cast("long") for c in graph.columns))).collect()
    assert sorted((x.core, x.size) for x in found) == [(c * 100, n * (n + 1) // 2) for c, n in ((1, 1), (2, 2), (3, 7), (4, 8), (5, 37))]


def test_awkward_rows_and_empty_tables(spark, check_s_like):
    rows = {(r.doc_id, r.n_words): r for r in debruijn.span_report(check_s_like).collect()}
    assert rows[(6, 60000)].n_removed == 0 and rows[(3, 0)].n_removed == 0
    assert rows[(None, 5)].n_removed == 0 and rows[(1, 42)].n_removed == 0
    assert debruijn.span_report(check_s_like).count() == 10
    assert debruijn.span_report(check_s_like.limit(0)).count() == 0
