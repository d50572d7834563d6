import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagewright.llm import bpe, lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def public():
    return Tokenizer.from_file(PATH)


TEXTS = [
    "Hello, World! It's we'll I'M they've 'sup 12345 3.14 don't''s",
    "ΣΊΣΥΦΟΣ İstanbul ǅ ﬁne é Å straße ẞ",
    "a b c\u0085d\x1ce​f　g\tx\r\ny",
    "<|startoftext|>Hi<|endoftext|> <|ENDOFTEXT|> <|endoftext| ><|endoftext|><|endoftext|>",
    "日本語テキスト 한국어 العربية हिन्दी 👩‍👩‍👧‍👦 🏳️‍🌈 ½ ² Ⅷ",
    "@@@###!!! --- ... aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa " + "ab" * 300,
    "",
    "\x00\x01 � \U0010ffff",
]


def test_merges_and_words_equal_the_public_library(public):
    vocabulary = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    r = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzéßñ0123456789'’!?., \n<|>ΣİЖ語👍́"
    texts = TEXTS + ["".join(r.choice(letters) for _ in range(r.randint(0, 200))) for _ in range(400)]
    for text in texts:
        ids = [i for p in vocabulary.parts(text) for i in ([p] if isinstance(p, int) else vocabulary.merged(p))]
        assert ids == public.encode(text, add_special_tokens=False).ids, text
        assert vocabulary.decoded(ids) == public.decode(ids, skip_special_tokens=False)


def test_query_equals_the_public_library(spark, tiny, check_s_like, public):
    extra = spark.createDataFrame(list(enumerate(TEXTS, 5000)), "doc_id long, text string")
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").union(extra)
    docs = docs.union(check_s_like.select("doc_id", "text"))
    want = []
    for row in docs.collect():
        ids = public.encode(row.text or "", add_special_tokens=False).ids
        text = public.decode(ids, skip_special_tokens=False)
        want.append((str(row.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [(str(r.doc_id), *r[1:]) for r in bpe.token_report(docs, PATH).collect()]
    assert sorted(got) == sorted(want)
    assert sorted(bpe.encode(docs, PATH, lexicon_words=3).select("ids_sha256").collect()) == sorted(bpe.encode(docs, PATH).select("ids_sha256").collect())
    encoded = bpe.encode(extra, PATH)
    back = {r.doc_id: r.decoded for r in bpe.decode(encoded.select("doc_id", "ids"), PATH).collect()}
    assert back == {r.doc_id: r.decoded for r in encoded.collect()}


def test_clashing_columns_and_empty_table(spark, check_s_like):
    assert bpe.token_report(check_s_like, PATH).count() == 10
    assert bpe.token_report(check_s_like.limit(0), PATH).count() == 0


def test_lexicon_ranks_ids_and_shared_suffixes(tmp_path):
    r = random.Random(7)
    entries = {bytes(r.choice(b"abc") for _ in range(r.randint(1, 7))) + b"tion": [r.randrange(50000) for _ in range(r.randint(1, 4))] for _ in range(500)}
    entries |= {b"tion": [1], b"\xff\x00": [2, 3]}
    path = tmp_path / "lexicon"
    path.write_bytes(lexicon.compiled(entries))
    lex = lexicon.Lexicon(str(path))
    words = sorted(entries)
    assert lex.ranks(words).tolist() == list(range(len(words)))
    assert [np.frombuffer(lex.ids_of_rank(k), np.uint32).tolist() for k in range(len(words))] == [entries[w] for w in words]
    assert lex.ranks([b"", b"tio", b"tionx", b"zz", b"aaaaaaaaaaaaaaaa"]).tolist() == [-1] * 5
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    rights = {}
    for p in prefixes:
        rights.setdefault(frozenset(w[len(p) :] for w in words if w.startswith(p)), p)
    assert lex.states == len(rights)
    path.write_bytes(lexicon.compiled({}))
    assert lexicon.Lexicon(str(path)).ranks([b"a"]).tolist() == [-1]
