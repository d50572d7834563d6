import itertools
import math
import random
import zlib

import numpy as np
import pytest

from pagewright.llm import letters, toxicity


@pytest.fixture(scope="module")
def model():
    counts = np.zeros(letters.SYMBOLS**letters.ORDER, np.int64)
    words = "the idiot and other stupid people were trash talking about the tree with a moron good book".split()
    letters.gram_counts([" ".join(words)] * 50, counts)
    return letters.LetterModel(counts)


def test_gram_counts_equal_a_loop():
    text = "Ab é!cde  f"
    counts = np.zeros(letters.SYMBOLS**letters.ORDER, np.int64)
    letters.gram_counts([text, "xy"], counts)
    want = {}
    for word in (["a", "b"], ["é"], ["c", "d", "e"], ["f"], ["x", "y"]):
        coded = [27 if c == "é" else ord(c) - 96 for c in word]
        padded = [0, 0, 0, *coded, 0]
        for k in range(len(padded) - 3):
            key = sum(x * letters.SYMBOLS ** (3 - j) for j, x in enumerate(padded[k : k + 4]))
            want[key] = want.get(key, 0) + 1
    assert {int(k): int(counts[k]) for k in np.flatnonzero(counts)} == want


@pytest.mark.parametrize(
    ("written", "read"),
    [("1d10t", "idiot"), ("idiooooot", "idiot"), ("i.d.i.o.t", "idiot"), ("$tup1d", "stupid"), ("tr@sh", "trash"), ("m0r0n", "moron")],
)
def test_disguised_words_are_read(model, written, read):
    assert letters.restored(written, model.decode) == read


def test_spaced_letters_and_plain_words(model):
    assert letters.words_restored("You I D I O T, what a b-o-o-k", model.decode) >= {"idiot", "you", "what"}
    for plain in ("tree", "good", "mail@x.example.com", "2024", "book!!!", "12a456"):
        assert letters.restored(plain, model.decode) in (plain, plain.strip("!"))


def test_viterbi_is_the_best_of_all_paths(model):
    def best(word):
        found = {}
        for ways in itertools.product(range(4), repeat=len(word)):
            state, text, score = 0, "", 0.0
            for c, way in zip(word, ways, strict=True):
                options = ([(c, letters.PLAIN)] if c.isalpha() else []) + [(x, letters.SWAPPED) for x in letters.LEET.get(c, "")]
                if way < 2:
                    if way >= len(options):
                        break
                    letter, cost = options[way]
                    score += cost + model.logs[state][ord(letter) - 96]
                    state, text = (state * letters.SYMBOLS + ord(letter) - 96) % letters.STATES, text + letter
                elif way == 2:
                    if not text or text[-1] not in [x for x, _ in options]:
                        break
                    score += letters.REPEATED
                else:
                    if c not in letters.FILLERS and c not in "!|+(":
                        break
                    score += letters.FILLER
            else:
                found[text] = max(found.get(text, -math.inf), score + model.logs[state][0])
        return max(found.items(), key=lambda kv: kv[1])[0]

    for word in ("1dii", "a!t", "tt-e", "0o.0", "m0r"):
        assert model.decode(word) == best(word)


def labelled(spark, n=600):
    r = random.Random(2)
    bad, disguised = ["idiot", "moron", "stupid"], ["1d10t", "m0r0n", "stuuuupid", "i d i o t"]
    plain = ["tree", "house", "water", "people", "other", "green", "about", "which", "their", "would"]
    docs, labels = [], []
    for k in range(n):
        words = [r.choice(plain) + r.choice(["", "s", "ing"]) for _ in range(r.randint(5, 60))]
        toxic = int(k % 4 == 0)
        for _ in range(2 * toxic):
            # Held-out documents also hold disguised forms that no label taught.
            held = zlib.crc32(str(k).encode()) % 5 == 0
            words.insert(r.randrange(len(words)), r.choice(disguised if held else bad))
        docs.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, 1, toxic))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_disguised_words_are_caught(spark):
    docs, labels = labelled(spark)
    rows = toxicity.toxicity_report(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_labels_of_held_out_rows_are_not_read(spark):
    from pyspark.sql import functions as F

    docs, labels = labelled(spark, 200)
    wrong = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    one = toxicity.toxicity_report(docs, labels).orderBy("doc_id").collect()
    two = toxicity.toxicity_report(docs, labels.withColumn("toxic", wrong)).orderBy("doc_id").collect()
    assert one == two


def test_awkward_rows_and_missing_labels(spark, check_s_like):
    docs, labels = labelled(spark, 200)
    rows = toxicity.toxicity_report(check_s_like, labels).collect()
    assert len(rows) == 10
    assert toxicity.toxicity_report(docs.limit(0), labels).count() == 0
    nothing = toxicity.toxicity_report(docs, labels.limit(0)).agg({"score": "max"}).first()[0]
    assert nothing == 0
    twice = labels.union(labels).union(spark.createDataFrame([(None, 1, 1), (3, 1, None)], labels.schema))
    assert toxicity.toxicity_report(docs, twice).orderBy("doc_id").collect() == toxicity.toxicity_report(docs, labels).orderBy("doc_id").collect()
    empty = spark.createDataFrame([(9999, None), (9998, "")], "doc_id long, text string")
    assert all(r.predicted == 0 for r in toxicity.toxicity_report(docs.select("doc_id", "text").union(empty), labels).where("doc_id > 9000").collect())


@pytest.mark.parametrize(
    "written",
    ["idi" + 30 * "o" + "t", "1d!07", "i...d...i...o...t", "iddiot", "you\u2014idiot", "you,idiot", "so\u2026idiot", "no?idiot", "no!1d10t", "i" + 5000 * "d" + "iot"],
)
def test_every_writing_is_read(model, written):
    assert "idiot" in letters.readings(written, model.decode)


def test_signs_for_most_letters(model):
    counts = np.zeros(letters.SYMBOLS**letters.ORDER, np.int64)
    letters.gram_counts(["the asshole and the other people"] * 50, counts)
    assert "asshole" in letters.readings("4$$h0l3", letters.LetterModel(counts).decode)


def test_toxic_word_in_text_without_spaces(model):
    scorer = toxicity.Scorer(model, {"idiot$": 3.0})
    assert scorer.lift("thepeoplewere" + "talkingabout" * 3 + "idiot" + "thetree" * 4) == 3.0
    assert scorer.lift("talkingabout" * 6) == 0.0


@pytest.mark.parametrize("n", [*range(5, 41, 5), 26, 25])
def test_joined_words_are_found_at_any_length(model, n):
    """No number of letters around a word makes a difference."""
    scorer = toxicity.Scorer(model, {"idiot$": 3.0})
    around = ("talkingaboutthetrees" * 3)[: n - 5]
    for token in (around + "idiot", "idiot" + around, around + "1d10t", around[: n // 2] + "i.d.i.o.t" + around[n // 2 :]):
        assert scorer.lift(token) == 3.0, token
    assert scorer.lift(around) == 0.0


def test_words_inside_others_that_clean_documents_hold_do_not_count(spark):
    """Here clean documents hold 'hate' inside 'whatever', and never 'idiot' inside another word."""
    docs, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = ["tree", "water", "house"] * 5 + (["hate", "idiot"] if toxic else ["xhatever"])
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    sample = spark.createDataFrame([(t, y) for (_, t), (_, y) in zip(docs, labels, strict=True)], "text string, toxic int")
    counts = np.zeros(letters.SYMBOLS**letters.ORDER, np.int64)
    letters.gram_counts([t for _, t in docs], counts)
    scorer = toxicity.Scorer(letters.LetterModel(counts))
    toxicity.learn_lifts(sample, scorer, 100, 300, toxicity.Settings())
    assert {"hate$", "idiot$"} <= scorer.lifts.keys() and scorer.inner.keys() == {"idiot"}
    assert scorer.lift("thatever") == 0.0 < scorer.lift("youidiotsthere")


@pytest.mark.parametrize("seed", range(3))
def test_the_prefilter_leaves_out_no_reading(seed):
    """Whatever is not decoded has no feature; so all lifts are those of decoding everything."""
    r = random.Random(seed)
    words = ["idiot", "stupid", "moron", "assess", "trash", "the", "tree", "people", "bookkeeper"]
    counts = np.zeros(letters.SYMBOLS**letters.ORDER, np.int64)
    letters.gram_counts([" ".join(words)] * 30, counts)
    model = letters.LetterModel(counts)
    lifts = {"idiot$": 2.0, "stup": 1.0, "moron$": 3.0, "assess": 4.0, "asse": 0.5, "trash$": 1.5}
    reach, gate, skipped, hits = letters.Reach(lifts), letters.Gate(lifts), 0, 0
    for _ in range(3000):
        word = r.choice(words) + r.choice(["", "", "s", "ing"])
        out = []
        for c in word:
            ways = [k for k, v in letters.LEET.items() if c in v]
            out.append(r.choice([c, c, c, c + c, c * 5, *ways]) + r.choice(["", "", "", *letters.FILLERS, "%"]))
        token = r.choice(["", "", "(", "?!", "a"]) + "".join(out) + r.choice(["", ".", "!!", "%", ",tree"])
        full = {f for w in letters.readings(token, model.decode) for f in toxicity.features(w)} & lifts.keys()
        some = {f for w in letters.readings_within(token, model.decode, reach) for f in toxicity.features(w)} & lifts.keys()
        assert some == full, token
        assert not full or token in gate.tokens(f"so {token}\u3000and\n"), token
        skipped += not full
        hits += bool(full)
    assert hits > 200 and skipped > 200


def test_query_equals_a_plain_loop(spark):
    """Every token of every document decoded, nothing remembered, nothing left out."""
    docs, labels = labelled(spark, 300)
    rows = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    settings = toxicity.Settings()
    counts = np.zeros(letters.SYMBOLS**letters.ORDER, np.int64)
    letters.gram_counts(list(rows.values()), counts)
    model = letters.LetterModel(counts)
    train = [k for k in rows if zlib.crc32(str(k).encode()) % 5]
    held = {k: {f for w in letters.words_restored(rows[k], model.decode) for f in toxicity.features(w)} for k in train}
    n_toxic = sum(toxic[k] for k in train)
    n_clean = len(train) - n_toxic
    lifts, inner = {}, {}

    def lift(a, b):
        x = math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))
        return x if x >= settings.least_lift and x / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= settings.least_z else 0

    for f in set().union(*held.values()):
        a, b = (sum(f in held[k] for k in train if toxic[k] == y) for y in (1, 0))
        if a >= max(settings.least_docs, settings.least_share * n_toxic) and lift(a, b):
            lifts[f] = lift(a, b)
            if f.endswith("$") and len(f) > 4:
                inside = sum(f[:-1] in token for k in train if not toxic[k] for token in [rows[k].lower()])
                if lift(a, inside):
                    inner[f[:-1]] = min(lifts[f], lift(a, inside))

    def of_token(token):
        words = letters.readings(token, model.decode)
        found = [lifts.get(f, 0) for w in words for f in toxicity.features(w)]
        return max([0, *found, *(x for i, x in inner.items() if any(i in w for w in words))])

    def summary(text):
        tokens = set(text.lower().split())
        hits = [x for x in map(of_token, tokens) if x]
        spaced = [max([lifts.get(f, 0) for f in toxicity.features(model.decode(w))], default=0) for w in letters.spaced_words(text.lower())]
        hits += [x for x in spaced if x]
        return [sum(hits), max(hits, default=0.0), len(hits), math.log1p(len(tokens))]

    x = np.array([summary(rows[k]) for k in train])
    y = np.array([toxic[k] for k in train], float)
    order = np.lexsort([y, *x.T])
    w = toxicity.fitted(x[order], y[order])
    want = {k: 1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(w, [1.0, *summary(t)])))))) for k, t in rows.items()}
    got = {r.doc_id: r.score for r in toxicity.toxicity_report(docs, labels).collect()}
    assert got.keys() == want.keys() and inner and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_the_gate_passes_over_plain_text():
    gate = letters.Gate(["idiot$", "stup", "bill$"])
    assert gate.tokens("the tree, and 12 other people! (whatever) talk.") == set()
    found = gate.tokens("an 1d!07 or i-d-i-o-t, st\u00b7up1d\u00a0b111 a+b you|d!ot (idiot)!!")
    assert found == {"1d!07", "i-d-i-o-t,", "st\u00b7up1d", "b111", "a+b", "you|d!ot", "(idiot)!!"}
    assert letters.Gate([]).tokens("a b") == set() and letters.Gate(["...$"]).tokens("a b") == {"a", "b"}
