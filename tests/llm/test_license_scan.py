"""Whole texts as templates, and spans that alignment tells apart."""

import random
import re

import pytest

from citemill.llm import license_scan

WORD = re.compile("[a-z0-9]+")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_whole_texts(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    licenses = [(f"l{k}", " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate((40, 200, 900))]
    say = lambda n: [f"o{rng.randrange(10**9)}" for _ in range(n)]
    texts, want = [], []
    for label, text in licenses:
        words = text.split()
        for edits, found in ((0, True), (0.02, True), (0.05, True), (0.9, False)):
            own = list(words)
            for _ in range(int(edits * len(own))):
                own[rng.randrange(len(own))] = say(1)[0]
            texts.append(" ".join(say(30)) + "\n* " + "; ".join(own).upper() + ".\n" + " ".join(say(9)))
            want.append((label if found else "", 1 - distance(own, words) / len(words)))
        texts.append(" ".join(words[: len(words) // 3]))
        want.append(("", 0))
        moved = words[len(words) // 2 :] + words[: len(words) // 2]
        texts.append(" ".join(moved))
        want.append(("", 0))
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, labels int")
    for r in license_scan.scan(docs, templates=licenses).collect():
        label, share = want[r.doc_id]
        assert r.labels == label, r.doc_id
        assert r.score == (pytest.approx(share, abs=0.02) if label else 0)


def test_odd_rows(spark):
    text = "Licensed under CC BY, all rights reserved. " * 3
    rows = [(1, None), (1, None), (2, ""), (None, text), (4, text), (4, text), (5, "word " * 60_000 + "cc by")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda r: (str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.score)
    assert sorted(map(str, map(key, got))) == sorted(map(str, [("1", 0, 0, None, None, "", 0.0)] * 2 + [("2", 0, 0, None, None, "", 0.0)] + [(i, 21, 6, 2, 18, "cc-by,reserved", 1.0) for i in ("None", "4", "4")] + [("5", 60_002, 1, 60_000, 60_000, "cc-by", 1.0)]))
    assert license_scan.scan(spark.createDataFrame(rows[:0], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        license_scan.grams([("x", "!!")])
