import random
import re

import pytest

from pagewright.llm import licenses

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    """All rules on the whole text, every pair of detections compared."""
    words = words_of(text)
    body = " ".join(words)
    at = lambda offset: body[:offset].count(" ")
    found = [(at(m.start()), at(m.end()), r) for r in licenses.rules() for m in r.pattern.finditer(body)]
    strength = lambda d: (-d[2].priority, d[0] - d[1], d[2].order, d[0])
    kept = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and strength(e) < strength(d) for e in found)]
    base = []
    for phrase, label in licenses.PHRASES.items():
        want = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    every = [(d[2].label, d[2].priority) for d in kept] + [(label, licenses.PHRASE_PRIORITY) for _, label in base]
    starts = [i for i, _ in base]
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in base})),
        ",".join(sorted({label for label, _ in every})),
        max((p for _, p in every), default=0) / 100,
    )


SAMPLES = [
    "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "SPDX-License-Identifier: GPL-3.0-or-later and also CC-BY-NC 4.0, cc by nc cc by nc cc by nc",
    "https://creativecommons.org/licenses/by-nc-sa/4.0/ or CC BY-NC-SA 4.0",
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "SPDX-License-Identifier: Foo-1.0",
    "permit the submit mitigated licensee", "", None, "Licence MIT", "Copyright 2020 by Some One. All rights reserved.",
]


def test_rules_are_many_and_hold_their_keywords():
    found = licenses.rules()
    assert len(found) >= 200 and len({r.label for r in found}) >= 80
    assert all(0 < r.priority <= 98 and r.keyword == r.keyword.lower().strip() for r in found)


@pytest.mark.parametrize("seed", range(6))
def test_equals_brute_force(spark, seed):
    r = random.Random(seed)
    plain = [re.sub(r"\(\?:|\)\??|\\\S+|\[sc\]|\||\?|\{.*?\}|\^|\$", lambda m: "c" if m[0] == "[sc]" else " ", x.pattern.pattern[7:-7]) for x in licenses.rules()]
    pieces = [*filter(None, SAMPLES), *plain, "lorem ipsum", "É à", "gpl", "version 2", "license"]
    docs = [(k, ", ".join(r.choice(pieces) for _ in range(r.randint(1, 12)))) for k in range(80)] + list(enumerate(SAMPLES, 1000))
    got = licenses.license_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted((i, *brute(t)) for i, t in docs)


def test_specific_answers(spark):
    rows = licenses.license_report(spark.createDataFrame(list(enumerate(SAMPLES)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert (rows[0].labels, rows[0].n_base, rows[0].first_word) == ("mit", 1, 1)
    assert rows[1].labels == "apache-2,apache-2.0" and rows[2].labels == "cc-by-nc,gpl-3" and rows[2].n_base == 4
    assert rows[3].labels == "cc-by-nc,cc-by-nc-sa" and rows[3].base_labels == "cc-by-nc"
    assert rows[4].labels == "gpl-3" and rows[6].labels == "other" and rows[7].labels == ""
    assert (rows[9].n_words, rows[9].score, rows[9].first_word) == (0, 0.0, None)


def test_awkward_rows(spark, check_s_like):
    assert licenses.license_report(check_s_like).count() == 10
    assert licenses.license_report(check_s_like.limit(0)).count() == 0


def alternatives(parsed):
    """Texts of all branches of a pattern; what may repeat comes as seldom as it may, and once."""
    texts = [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            ways = [chr(value)]
        elif name == "IN":
            ways = [chr(v) if str(o) == "LITERAL" else {"CATEGORY_DIGIT": "1"}.get(str(v), "x") for o, v in value]
        elif name == "SUBPATTERN":
            ways = alternatives(value[-1])
        elif name == "BRANCH":
            ways = [text for branch in value[1] for text in alternatives(branch)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            once = alternatives(value[2])
            ways = list(dict.fromkeys(text * n for n in {value[0], max(value[0], 1)} for text in once))
        else:
            assert name in ("AT", "ASSERT", "ASSERT_NOT"), name
            ways = [""]
        texts = [a + b for a in texts for b in ways]
    return texts


def test_each_alternative_holds_its_keyword():
    from re import _parser

    from pagewright.llm.license_rules import RULES

    for line in RULES.strip().splitlines():
        label, _, keyword, pattern = (part.strip() for part in line.split(" | ", 3))
        for text in alternatives(_parser.parse(pattern)):
            assert f" {keyword} " in f" {text} ", (label, keyword, text)
