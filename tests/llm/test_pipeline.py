import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from pagewright.llm import minhash
from llm.test_decontam import words_of
from llm.test_minhash import brute as near_classes
from llm.test_suffixes import brute as repeats

LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(folder, spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    item, passage = prose(30), prose(80)
    texts, toxic = {}, set()
    for k in range(150):
        words = prose(r.randint(30, 90)).split()
        if k % 5 == 0:
            toxic.add(k)
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["idiot", "moron", "stupid"]))
        texts[k] = " ".join(words)
    texts[200], texts[201] = texts[1], texts[2] + " Extra."
    for k in (210, 211):
        texts[k] = prose(40) + " " + passage + " " + prose(40)
    texts[220] = prose(50) + ". " + item.upper() + ", " + prose(50)
    texts |= {230: None, 231: "", 232: "?!"}
    rows = [(k, t, "en", "s", len(t) if t else 0) for k, t in texts.items()]
    labels = [(k, 1, int(k in toxic)) for k in range(150)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts, toxic, item, passage


def test_pipeline_equals_brute_force_stage_by_stage(spark, tmp_path):
    folder = str(tmp_path)
    texts, toxic, item, passage = corpus(folder, spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, results = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == columns
        results[name] = {r.doc_id: r.text for r in docs.collect()}
        assert all(r.n_chars == len(r.text or "") for r in docs.collect())
    held = {k for k in toxic if zlib.crc32(str(k).encode()) % 5 == 0}
    assert held and not toxic & results["toxicity"].keys()
    assert results["toxicity"] == {k: t for k, t in texts.items() if k not in toxic}

    before = sorted(results["toxicity"].items())
    classes = near_classes(before, minhash.Settings())
    assert sorted(results["near_duplicates"]) == sorted(c[0] for c in classes)
    assert 200 not in results["near_duplicates"] and 201 not in results["near_duplicates"]

    want = {i: digest for i, _, _, _, digest in repeats(sorted(results["near_duplicates"].items()), corpus_pipeline.REPEAT_BYTES)}
    got = {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in results["repeats"].items()}
    assert got == want
    assert all(passage not in (t or "") for t in results["repeats"].values())

    changed = {k for k, t in results["benchmark"].items() if t != results["repeats"][k]}
    assert changed == {220} and results["benchmark"].keys() == results["repeats"].keys()
    left = words_of(results["benchmark"][220])
    whole = words_of(texts[220])
    assert left == whole[:50] + whole[80:]

    public = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == results["benchmark"].keys()
    for r in rows:
        ids = public.encode(results["benchmark"][r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_awkward_rows_and_empty_tables(spark, tmp_path, check_s_like):
    """Document 2 is a copy, and 6 and 7 repeat themselves throughout."""
    for name, docs in (("awkward", check_s_like), ("empty", check_s_like.limit(0))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS).write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, folder).columns == docs.columns
        rows = corpus_pipeline.run(spark, folder).collect()
        assert sorted(str(r.doc_id) for r in rows) == (sorted(["1", "3", "4", "5", "None", "8"]) if name == "awkward" else [])
