"""Hits against brute force over all windows, in one block and in many."""

import random
import re

import pytest

import corpus_pipeline
from citemill.llm import decontaminate


def words(text):
    return re.findall("[a-z0-9]+", (text or "").lower())


def brute(docs, items, window=13, find=words):
    """(n_words, hit words, items) of each text."""
    grams = {}
    for name, text in items:
        w = find(text or "")
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(name)
    for text in docs:
        w, hit, found = find(text or ""), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[tuple(w[i : i + n])]
        yield len(w), hit, sorted(found, key=lambda x: (x is None, x or ""))


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    say = lambda n: rng.choices(vocabulary, k=n)
    items = [(f"i{k}", " ".join(say(rng.choice([1, 3, 12, 13, 14, 40, 90])))) for k in range(25)]
    items += [("long", " ".join(f"u{i}" for i in range(400))), ("i1", items[1][1]), (None, "none of these"), ("empty", "!!"), ("null", None)]
    texts = [None, "", "!! ?"]
    for _ in range(80):
        parts = say(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(w) + 1)
            parts += w[a : a + rng.randint(1, 60)] + say(rng.randint(0, 5))
        texts.append(" ".join(parts).upper() if rng.random() < 0.3 else " ".join(parts))
    return texts + [texts[20]] * 3 + ["x " * 50_000 + items[5][1]], items


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 600, 120])
def test_hits(spark, cases, block_words):
    texts, items = cases
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, _key string, Spans int")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    out = decontaminate.judged(docs, benchmark, block_words=block_words)
    assert set(out.columns) == {"doc_id", "text", "_key", "n_words", "spans", "items", "n_hit", "n_items", "contaminated"}
    got = out.orderBy("doc_id").collect()
    for r, (n, hit, found) in zip(got, brute(texts, items), strict=True):
        assert (r.n_words, r.n_hit, r["items"], r.n_items) == (n, len(hit), found, len(found)), r.doc_id
        assert {i for s in r.spans for i in range(s["lo"], s["hi"])} == hit
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= n)
    cut = decontaminate.without_spans(out).orderBy("doc_id").collect()
    for r, c in zip(got, cut, strict=True):
        gone = {i for s in r.spans if s["hi"] - s["lo"] >= 13 for i in range(s["lo"], s["hi"])}
        assert (c.text is None) == (r.text is None)
        assert words(c.text) == [w for i, w in enumerate(words(r.text)) if i not in gone]


def test_cut_keeps_what_stands_around(spark):
    docs = spark.createDataFrame([(1, "Say: a b, c; and «d» stay."), (2, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([("1", "A b C")], "item_id string, text string")
    got = decontaminate.without_spans(decontaminate.judged(docs, items), min_words=1).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["Say: and «d» stay.", ""]


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 120])
def test_cut_at_once(spark, cases, block_words):
    """Judging that cuts gives what cutting after it does."""
    docs = spark.createDataFrame(list(enumerate(cases[0])), "doc_id long, text string")
    benchmark = spark.createDataFrame(cases[1], "item_id string, text string")
    once = decontaminate.judged(docs, benchmark, block_words=block_words, cut=13)
    after = decontaminate.without_spans(decontaminate.judged(docs, benchmark, block_words=block_words))
    assert once.columns == after.columns
    got, want = once.orderBy("doc_id").collect(), after.orderBy("doc_id").collect()
    assert got == want and any(r.text != t for r, t in zip(got, cases[0], strict=True))


def test_pipeline_cuts_with_one_worker_a_task(spark):
    """A second map in the same tasks leaves each executor with twice as many Python workers, for all later stages."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.drop_contaminated(spark, docs, "/root/testdata/sf0.001")
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_empty_tables(spark, cases):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("1", "a b")], "item_id string, text string")
    r = decontaminate.judged(docs, items.limit(0)).first()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (2, 0, 0, False)
    assert decontaminate.judged(docs.limit(0), items).count() == 0


def test_pieces():
    whole = [str(i).encode() for i in range(100)]
    for most in (1, 26, 30, 99, 100, 500):
        got = list(decontaminate.pieces_of(whole, most, 13))
        assert {tuple(p[i : i + 13]) for p in got for i in range(len(p) - 12)} == {tuple(whole[i : i + 13]) for i in range(88)}
        assert all(13 <= len(p) <= max(most, 26) for p in got)
    assert list(decontaminate.pieces_of([], 5, 13)) == []
