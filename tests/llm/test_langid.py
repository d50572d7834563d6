import math
import random
import zlib

import numpy as np

from pagewright.llm import langid
from pagewright.llm.words import mixed


def corpus(spark, n=300):
    r = random.Random(1)
    syllables = {"aa": ["tha", "ing", "ow", "er"], "bb": ["sch", "ung", "ei", "ö"], "cc": ["que", "eau", "é", "ou"]}
    rows = []
    for k in range(n):
        lang = r.choice(list(syllables))
        text = " ".join("".join(r.choice(syllables[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(2, 80)))
        rows.append((k, text.title(), lang if k % 17 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_features_equal_a_loop():
    text = "Ab-é 9 Ωz"
    spelled = " ab é ωz "
    want = {}
    for n in (1, 2, 3):
        for k in range(len(spelled) - n + 1):
            key = 0
            for c in spelled[k : k + n]:
                key = (key << 21) | ord(c)
            at = int(mixed(np.array([key + n], np.uint64))[0] >> np.uint64(64 - langid.BITS))
            want[at] = want.get(at, 0) + 1
    assert dict(zip(*(x.tolist() for x in langid.feature_counts(text)), strict=True)) == want
    assert langid.feature_counts("12 !?") is None and langid.feature_counts("") is None


def test_held_out_accuracy_and_folds(spark):
    docs = corpus(spark)
    rows = langid.identify(docs).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_languages_are_never_read(spark):
    from pyspark.sql import functions as F

    docs = corpus(spark, 120)
    hidden = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "zz").otherwise(F.col("lang")))
    assert langid.identify(docs).orderBy("doc_id").collect() == langid.identify(hidden.repartition(5)).orderBy("doc_id").collect()


def test_most_weights_are_zero_and_temperature_is_calibrated(spark):
    model = langid.train(corpus(spark), "doc_id", "text", "lang", langid.Settings())
    assert (model.weights == 0).mean() > 0.9 and model.languages == ["aa", "bb", "cc"]
    r = np.random.default_rng(0)
    logits = r.normal(size=(4000, 3)) * 2
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    labels = np.array([r.choice(3, p=x) for x in p])
    assert math.isclose(langid.temperature_for(logits * 3, labels), 3, rel_tol=0.1)


def test_awkward_rows(spark, check_s_like):
    rows = langid.identify(check_s_like).collect()
    assert len(rows) == 10
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {3, 4, 5, 8} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert langid.identify(check_s_like.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, "words here", None)], "doc_id long, text string, lang string")
    assert langid.identify(blank).first().lang_pred == "und"


def spelled(text):
    """Counts of n-grams by a loop; None without a letter."""
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    letters = " " + " ".join(letters.split()) + " "
    if not letters.strip():
        return None
    out = {}
    for n in (1, 2, 3):
        for k in range(len(letters) - n + 1):
            key = 0
            for c in letters[k : k + n]:
                key = (key << 21) | ord(c)
            at = int(mixed(np.array([(key + n) % (1 << 64)], np.uint64))[0] >> np.uint64(64 - langid.BITS))
            out[at] = out.get(at, 0) + 1
    return out


def test_query_equals_a_plain_loop(spark):
    """Frequencies, FTRL and calibration one number at a time."""
    import xxhash

    docs = corpus(spark, 90)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    s = langid.Settings()
    train = [(spelled(t), lang) for k, t, lang in rows if zlib.crc32(str(k).encode()) % 3 != 1 and lang]
    train = [(f, lang) for f, lang in train if f]
    df = {}
    for f, _ in train:
        for at in f:
            df[at] = df.get(at, 0) + 1
    total = len(train)
    idf = lambda at: math.log((total + 1) / (df.get(at, 0) + 1)) + 1

    def weighted(f):
        x = {at: (1 + math.log(n)) * idf(at) for at, n in f.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {at: v / norm for at, v in x.items()}

    def order(row):
        at = sorted(row[0])
        return xxhash.xxh3_64_intdigest(np.array(at, np.int32).tobytes() + np.array([row[0][k] for k in at], np.int32).tobytes()), row[1]

    train.sort(key=order)
    langs = sorted({lang for _, lang in train})
    held = []
    for lang in langs:
        own = [row for row in train if row[1] == lang]
        held += own[: len(own) // 5]
    train = [row for row in train if row not in held]
    z, n = {}, {}

    def weight(at, c):
        zz = z.get((at, c), 0.0)
        return -math.copysign(max(abs(zz) - s.l1, 0.0), zz) / ((s.beta + math.sqrt(n.get((at, c), 0.0))) / s.alpha + s.l2)

    def logits(f):
        x = weighted(f) | {"constant": 1.0}
        return [sum(v * weight(at, c) for at, v in x.items()) for c in range(len(langs))]

    for _ in range(s.epochs):
        for f, lang in train:
            out = logits(f)
            p = [math.exp(v - max(out)) for v in out]
            x = weighted(f) | {"constant": 1.0}
            steps = {}
            for c in range(len(langs)):
                error = p[c] / sum(p) - (langs[c] == lang)
                for at, v in x.items():
                    g, before = v * error, n.get((at, c), 0.0)
                    sigma = (math.sqrt(before + g * g) - math.sqrt(before)) / s.alpha
                    steps[(at, c)] = (g - sigma * weight(at, c), g * g)
            for key, (dz, dn) in steps.items():
                z[key], n[key] = z.get(key, 0.0) + dz, n.get(key, 0.0) + dn
    heat = langid.temperature_for(np.array([logits(f) for f, _ in held]), np.array([langs.index(x) for _, x in held]))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs).collect()}
    for k, text, _ in rows:
        f = spelled(text)
        out = [v / heat for v in logits(f)] if f else [0.0]
        p = [math.exp(v - max(out)) for v in out]
        lang, score = got[k]
        assert lang == (langs[p.index(max(p))] if f else "und")
        assert abs(score - (max(p) / sum(p) if f else 0.0)) < 1e-6


def test_many_languages_and_rare_ones_are_learned(spark):
    """250 languages, one with a third of the documents, the others with ten each, of which about three are held out."""
    r = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèêçñåæøłśžđ"
    syllables = [["".join(r.choice(letters) for _ in range(3)) for _ in range(5)] for _ in range(250)]
    text = lambda x: " ".join("".join(r.choice(syllables[x]) for _ in range(2)) for _ in range(25))
    rows = [(k, text(k % 250), f"l{k % 250:03}") for k in range(2500)] + [(3000 + k, text(0), "l000") for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    settings = langid.Settings(language_docs=60)
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, settings=settings).collect()}
    held = [(k, lang) for k, _, lang in rows if zlib.crc32(str(k).encode()) % 3 == 1 and k < 3000]
    assert sum(got[k] == lang for k, lang in held) >= 0.95 * len(held)
    assert {got[k] for k, _ in held} == {lang for _, lang in held}


def test_the_sample_is_bounded_for_each_language(spark):
    rows = [(k, f"text {k}", "big" if k % 10 else f"small{k % 50}") for k in range(1000)]
    docs = spark.createDataFrame(rows, "id long, text string, lang string").repartition(7)
    counts = lambda s: {r.of_lang: r["count"] for r in langid._chosen(docs, s).groupBy("of_lang").count().collect()}
    assert counts(langid.Settings(language_docs=15)) == {"big": 15} | {f"small{k}": 15 for k in range(0, 50, 10)}
    assert counts(langid.Settings(sample_docs=30)) == {"big": 5} | {f"small{k}": 5 for k in range(0, 50, 10)}
    import pytest

    with pytest.warns(UserWarning, match="2 languages"):
        assert counts(langid.Settings(most_languages=2, language_docs=3)) == {"big": 3, "small0": 3}
