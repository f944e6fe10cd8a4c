"""Near duplicates against brute force, on both sides: no alike pair is parted, no unlike one joined but through a chain of alike ones."""

import collections
import random
import re

import numpy as np
import pytest

from citemill.llm import near_dedup

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(rng, n):
    return [f"w{rng.getrandbits(40):x}" for _ in range(n)]


def kmers(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    seen, out = collections.Counter(), []
    for i in range(max(1, len(w) - 4)) if w else ():
        g = tuple(w[i : i + 5])
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def lcs_similarity(a, b):
    """By dynamic programming over the whole table."""
    row = np.zeros(len(b) + 1, np.int64)
    index = collections.defaultdict(list)
    for j, g in enumerate(b):
        index[g].append(j)
    for g in a:
        before = row.copy()
        for j in index[g]:
            row[j + 1 :] = np.maximum(row[j + 1 :], before[j] + 1)
    m = int(row[-1])
    return m / (len(a) + len(b) - m)


def brute_classes(texts, threshold=0.8):
    """The class of each text: the least index it is connected with."""
    grams = [kmers(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = collections.defaultdict(list)
    for i, g in enumerate(grams):
        for x in set(g):
            by[x].append(i)
    common = collections.Counter((i, j) for own in by.values() for k, j in enumerate(own) for i in own[:k])
    equal = {}
    for i, t in enumerate(texts):
        first = equal.setdefault(tuple(grams[i]) or (t or ""), i)
        root[find(max(i, first))] = find(min(i, first))
    for (i, j), c in common.items():
        if c >= threshold * (len(grams[i]) + len(grams[j]) - c) and find(i) != find(j) and lcs_similarity(grams[i], grams[j]) >= threshold:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: find(i) for i in range(len(texts))}


def class_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 16])
def test_pairs_in_crowded_buckets(spark, monkeypatch, block):
    """Copies in pairs, all with one common passage: their keys fall into crowded buckets, whose hubs are near no copy."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(5)
    passage, texts = words(rng, 85), []
    for _ in range(300):
        own = words(rng, 24)
        texts += [" ".join(passage + own), " ".join(passage + own[:-9] + words(rng, 9))]
    got = class_of(spark, texts)
    assert got == {i: i - i % 2 for i in range(600)}


def test_edits_of_all_kinds(spark):
    """Copies with words replaced, left out or put in, at every distance from the threshold."""
    rng = random.Random(11)
    texts = []
    for _ in range(120):
        own = words(rng, rng.randint(5, 120))
        texts.append(" ".join(own))
        for _ in range(rng.randint(0, 4)):
            edit = rng.choice("rdi")
            at = rng.randrange(len(own))
            own = own[:at] + ([] if edit == "d" else words(rng, 1)) + own[at + (edit != "i") :]
        texts.append(" ".join(own))
    assert class_of(spark, texts) == brute_classes(texts)


def test_documents(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    want, got = brute_classes([r.text for r in rows]), class_of(spark, [r.text for r in rows])
    assert got == want


def test_order_counts(spark):
    """Blocks in another order, or a text repeated, are edits."""
    rng = random.Random(7)
    blocks = [words(rng, 60) for _ in range(6)]
    a, b = " ".join(sum(blocks, [])), " ".join(sum(blocks[::-1], []))
    hashed = [near_dedup.word_hashes([w.encode() for w in t.split()]) for t in (a, b)]
    assert not near_dedup.alike(*hashed) and near_dedup.alike(hashed[0], hashed[0])
    assert class_of(spark, [a, b, a + " " + a, a]) == {0: 0, 1: 1, 2: 2, 3: 0}


def test_chain_in_the_band_is_exact():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 12, rng.integers(5, 60)).astype(np.uint32)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 3))) if rng.random() < 0.7 else rng.permutation(a)
        x, y = near_dedup.labelled(a, 2), near_dedup.labelled(b, 2)
        want = lcs_similarity(x.tolist(), y.tolist()) if len(x) and len(y) else 0.0
        got = near_dedup.similarity(x, y)
        assert got == want or (got < 0.8 and want < 0.8)


def test_signatures_rule_out_no_close_pair():
    rng = np.random.default_rng(1)
    for n in (5, 50, 500, 5000):
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        y = np.concatenate([x[n // 10 :], rng.integers(0, 2**63, n // 10).astype(np.uint64)])
        a, b = (np.frombuffer(near_dedup.signature(v), np.uint64) for v in (x, y))
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "A, b!"), (4, "!!"), (5, "!!"), (6, "word " * 30_000), (7, "word " * 30_001), (None, "alone here")]
    docs = spark.createDataFrame([(*r, "n", 1, "x", 2) for r in rows], "doc_id long, text string, Node string, rows int, _n string, _i int")
    got = collections.Counter((r.doc_id, r.class_id, r.class_size) for r in near_dedup.classes(docs).collect())
    assert got == collections.Counter([(1, 1, 2), (2, 1, 2), (3, 3, 3), (3, 3, 3), (None, 3, 3), (4, 4, 2), (5, 4, 2), (6, 6, 2), (7, 6, 2), (None, None, 1)])
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted((str(r.doc_id), r.text[:9] if r.text else r.text, r.Node, r.rows) for r in kept.collect()) == [
        ("1", None, "n", 1), ("3", "a b", "n", 1), ("4", "!!", "n", 1), ("6", "word word", "n", 1), ("None", "alone her", "n", 1)
    ]
    assert near_dedup.classes(docs.limit(0)).count() == 0 and near_dedup.keep_one(docs.limit(0)).count() == 0
