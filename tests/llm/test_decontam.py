import hashlib
import re

from pagewright.llm import decontam

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=10):
    windows = []
    for item_id, text in items:
        words = words_of(text)
        n = min(size, len(words))
        windows += [(str(item_id), words[i : i + n]) for i in range(len(words) - n + 1) if n and item_id is not None]
    out = []
    for doc_id, text in docs:
        words, hit, owners = words_of(text), set(), set()
        for item_id, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    owners.add(item_id)
        digest = hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(owners), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [
    (1, "the quick BROWN fox jumps, over the lazy dog near the river"),
    (10, "Ça va"),
    (2, "quick brown fox jumps over the lazy dog near the river bank"),
    (3, None),
    (4, "..."),
    (None, "today the quick"),
    (5, "word word word"),
    (5, "null id"),
]


def test_equals_brute_force_in_one_and_many_blocks(spark, check_s_like):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = check_s_like.where("doc_id is null or doc_id <> 6").select("doc_id", "text")
    expected = brute([tuple(r) for r in docs.collect()], ITEMS)
    got = decontam.contamination_report(check_s_like.where("doc_id is null or doc_id <> 6"), items)
    assert sorted(map(tuple, got.collect()), key=str) == expected
    found = decontam.find_contamination(docs, items, block_bytes=100)
    spans = {(r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), len(r["items"])) for r in found.collect()}
    assert spans == {row[:4] for row in expected}


def test_long_text_and_empty_tables(spark, check_s_like):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    long = decontam.contamination_report(check_s_like.where("doc_id = 6"), items).first()
    assert (long.n_words, long.n_hit, long.n_items) == (60000, 60000, 1)
    assert decontam.contamination_report(check_s_like.limit(0), items).count() == 0
    none = decontam.contamination_report(check_s_like, items.limit(0))
    assert none.count() == 10 and none.where("contaminated").count() == 0


def test_removal_keeps_clean_rows_and_columns(spark, check_s_like):
    items = spark.createDataFrame([(1, "null id with words"), (2, "river bank")], "item_id long, text string")
    kept = decontam.remove_contamination(check_s_like, items)
    assert kept.schema.names == check_s_like.schema.names
    rows = {(r.doc_id, r.text) for r in kept.collect()}
    assert (None, "a ") in rows and (3, None) in rows and (8, "!!! ??? ...") in rows
    assert all("river bank" not in (text or "") for _, text in rows)
    assert kept.count() == 10


def test_a_block_is_used_before_the_next_is_collected(spark, check_s_like, monkeypatch):
    steps = []
    blocks, written = decontam._blocks, decontam.written

    def collected(*args):
        for block in blocks(*args):
            steps.append("collect")
            yield block

    def noted(df, label):
        steps.append("write")
        return written(df, label)

    monkeypatch.setattr(decontam, "_blocks", collected)
    monkeypatch.setattr(decontam, "written", noted)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = check_s_like.select("doc_id", "text")
    decontam.find_contamination(docs, items, block_bytes=250)
    assert steps == ["collect", "write"] * (len(steps) // 2) + ["collect"] and len(steps) > 1


def test_a_block_takes_few_bytes(monkeypatch):
    """Windows are numbers into the block's bytes; equal ones stand there once for all their items."""
    import pickle
    import random

    r = random.Random(1)
    items = [(str(k), " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(200)).encode()) for k in range(400)]
    windows = decontam.WindowSet(items + [("again", items[0][1])], 10)
    size = sum(len(raw) for _, raw in items)
    assert len(pickle.dumps(windows)) < 8 * size
    found = windows.sizes[10]
    assert len(found["hashes"]) == 400 * 191 and len(found["owners"]) == 401 * 191
    marks, hits = windows.scan(decontam.Words(b"so " + items[0][1] + b" and"))
    assert {windows.item_ids[k] for k in hits} == {"0", "again"} and marks.sum() == 200


def test_windows_with_equal_hashes_are_told_apart(spark, check_s_like, monkeypatch):
    """With a hash that is the same for all windows, only the bytes decide."""
    import numpy as np

    from pagewright.llm.words import Words

    items = [(str(i), (t or "").encode()) for i, t in ITEMS if i is not None]
    monkeypatch.setattr(Words, "runs", lambda self, n: np.full(max(0, len(self) - n + 1), 7, np.uint64))
    windows = decontam.WindowSet(items, 10)
    for doc, text in check_s_like.where("doc_id <> 6").select("doc_id", "text").collect():
        words = words_of(text)
        _, hits = windows.scan(Words((text or "").encode()))
        want = set()
        for item, raw in items:
            own = words_of(raw.decode())
            n = min(10, len(own))
            inside = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
            if n and any(tuple(own[k : k + n]) in inside for k in range(len(own) - n + 1)):
                want.add(item)
        assert {windows.item_ids[k] for k in hits} == want


def test_removal_in_many_blocks_equals_one(spark, check_s_like, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    one = sorted(map(str, decontam.remove_contamination(check_s_like, items).collect()))
    blocks = decontam._blocks
    monkeypatch.setattr(decontam, "_blocks", lambda a, b, c, _: blocks(a, b, c, 100))
    assert sorted(map(str, decontam.remove_contamination(check_s_like, items).collect())) == one
