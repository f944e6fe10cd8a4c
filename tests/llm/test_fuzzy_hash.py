"""Fingerprints against an implementation byte by byte, and the order of documents."""

import hashlib
import random

import pyarrow as pa
import pytest

from citemill.llm import fuzzy_hash
from citemill.llm import queries as Q

SF = "/root/testdata/sf0.001"
M64 = (1 << 64) - 1


def mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M64
    return x ^ (x >> 31)


def plain_fingerprint(text):
    if not text:
        return "3:::"
    rolled = []
    for i in range(len(text)):
        h = 0
        for k in range(7):
            c = text[i - 6 + k] if i - 6 + k >= 0 else 0
            h = (h + c * (k + 2)) & 0xFFFFFFFF
            h ^= (c << (5 * (6 - k) % 32)) & 0xFFFFFFFF
        h = h * 0x9E3779B1 & 0xFFFFFFFF
        rolled.append(h ^ (h >> 15))

    def signature(block):
        out, piece, power, left = "", 0, 1, 63
        for i, c in enumerate(text):
            piece, power = (piece + (c + 1) * power) & M64, power * 0x100000001B3 & M64
            if i == len(text) - 1 or (left and rolled[i] % block == block - 1):
                left -= rolled[i] % block == block - 1
                out += chr(fuzzy_hash.ALPHABET[mix(piece) >> 40 & 63])
                piece, power = 0, 1
        return out

    block = 3
    while block * 64 < len(text):
        block *= 2
    while block > 3 and len(signature(block)) < 32:
        block //= 2
    return f"{block}:" + ":".join(signature(k * block) for k in (1, 2, 4))


def plain_likeness(x, y):
    def one(a, b):
        if a == b:
            return 1.0
        if not a or not b:
            return 0.0
        n = min(4, max(1, min(len(a), len(b)) // 3))
        if not {a[i : i + n] for i in range(len(a) - n + 1)} & {b[i : i + n] for i in range(len(b) - n + 1)}:
            return 0.0
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], last if c == d else 1 + min(row[j], row[j - 1])
        return 1 - row[-1] / (len(a) + len(b))

    if x == y:
        return 1.0
    (bx, *xs), (by, *ys) = x.split(":"), y.split(":")
    return max((one(a, b) for i, a in enumerate(xs) for j, b in enumerate(ys) if int(bx) << i == int(by) << j), default=0.0)


@pytest.mark.parametrize("size", [fuzzy_hash.RANGE_BYTES, 4000, 1])
def test_against_plain(spark, monkeypatch, size):
    monkeypatch.setattr(fuzzy_hash.with_next, "__kwdefaults__", {"range_bytes": size})
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in Q.queries()["op3_fuzzy_hash"](spark, SF).collect()}
    assert len(got) == len(docs)
    texts = [r.text or "" for r in docs]
    for k, d in enumerate(docs):
        following = texts[(k + 1) % len(docs)]
        n = len(texts[k]) // 2
        changed = texts[k][: len(texts[k]) - n] + following[:n]
        r = got[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(texts[k]), hashlib.sha256(changed.encode()).hexdigest())
        if k % 4 == 0 and len(changed) < 3000:
            own, after, then = (plain_fingerprint(t.encode()) for t in (texts[k], changed, following))
            assert (r.fingerprint, r.edited_fingerprint) == (own, after)
            assert r.near_edited == pytest.approx(plain_likeness(own, after)) and r.near_next == pytest.approx(plain_likeness(own, then))


def test_order_of_odd_rows(spark):
    rng = random.Random(1)
    rows = [(None, None), (None, "z"), (5, "a"), (5, "b"), (5, "b"), (7, ""), (9, "word " * 100_000)] + [(i, "t" * i) for i in range(100, 160)]
    rng.shuffle(rows)
    schema = pa.schema([("a", pa.int64()), ("t", pa.string()), ("n", pa.string())])

    def seen(pairs):
        rows = list(pairs)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    for size in (1 << 20, 30):
        got = fuzzy_hash.with_next(spark.createDataFrame(rows, "doc_id long, text string"), seen, "a long, t string, n string", range_bytes=size).collect()
        assert sorted((r.a or -1, r.t) for r in got) == sorted((a or -1, t or "") for a, t in rows)
        follow = {}
        for r in got:
            follow.setdefault((r.a, r.t), []).append(r.n)
        assert follow[7, ""] == ["word " * 100_000] and follow[9, "word " * 100_000] == ["t" * 100] and follow[159, "t" * 159][0] in ("", "z")
        assert sorted(x for k in ((5, "a"), (5, "b")) for x in follow[k]) in (sorted(["b", "b", ""]), sorted(["a", "b", ""]))
    one = spark.createDataFrame([(1, "only")], "doc_id long, text string")
    assert [r.n for r in fuzzy_hash.with_next(one, seen, "a long, t string, n string").collect()] == ["only"]
    assert fuzzy_hash.with_next(one.limit(0), seen, "a long, t string, n string").count() == 0


def test_further_columns(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "ab", "y")], "doc_id long, text string, Fingerprint string")
    out = fuzzy_hash.fingerprints(docs)
    assert out.columns == ["doc_id", "text", "fingerprint"] and out.orderBy("doc_id").first().fingerprint == "3:::"
