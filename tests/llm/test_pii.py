"""Surrogates against a cipher in Python, and what the kinds ask for."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from citemill.llm import pii

KEY = "k"


def alphabet(c, hexadecimal=False):
    if c.isdigit():
        return "0123456789"
    if hexadecimal and c in "abcdef":
        return "abcdef"
    return next(a for a in ("aeiou", "bcdfghjklmnpqrstvwxyz", pii._LATIN_VOWELS, pii._LATIN_CONSONANTS, pii._CYRILLIC) if c in a)


def enciphered(value, tweak):
    at = [i for i, c in enumerate(value) if c.isalnum()]
    s = "".join(value[i].lower() for i in at)
    left, right = s[: len(s) // 2], s[len(s) // 2 :]
    for turn in range(4):
        pad = hashlib.sha256("|".join([KEY, tweak, str(turn), right]).encode()).digest()
        moved = ""
        for i, c in enumerate(left):
            a = alphabet(c, tweak.startswith("secret"))
            moved += a[(a.index(c) + pad[i % 32]) % len(a)]
        left, right = right, moved
    out = list(value)
    for i, c in zip(at, left + right, strict=True):
        out[i] = c if value[i] == value[i].lower() else c.upper()
    return "".join(out)


def turned(ranks, sizes, tweak):
    ranks = list(ranks)
    for turn in range(9):
        k = turn % 3
        others = ",".join("" if i == k else str(x) for i, x in enumerate(ranks))
        move = int(hashlib.sha256("|".join([KEY, tweak, str(turn), others]).encode()).hexdigest()[:12], 16)
        ranks[k] = (ranks[k] + move) % sizes[k]
    return ranks


def luhn(d):
    return (10 - sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(d)))) % 10


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def made(spark, values, **options):
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    rows = pii.with_surrogates(docs, key=KEY, **options).orderBy("doc_id").collect()
    assert [(len(r.entities), r.entities[0].value) for r in rows] == [(1, v) for v in values]
    assert all(r.text == r.entities[0].surrogate for r in rows)
    return {v: r.text for v, r in zip(values, rows, strict=True)}


def test_cipher(spark):
    rng = random.Random(1)
    hexes = ["".join(rng.choices("0123456789abcdef", k=n)) for n in (32, 40, 64) * 4]
    assert made(spark, hexes) == {v: enciphered(v, "secret:0:") for v in hexes}
    phones = ["+44 (555) 123-4567", "555-123-4567", "+1 555 123 4567"]
    got = made(spark, phones)
    assert got["555-123-4567"] == enciphered("555-123-4567", "phone:0:") and got[phones[0]] == "+44" + enciphered(" (555) 123-4567", "phone:0:")
    mails = ["Jürgen@x.de"[1:].replace("ü", "u"), "a.B-9@mail.Host.org", "x@example.com"]
    for v, s in made(spark, mails).items():
        own, domain = v.split("@")
        stem, last = domain.rsplit(".", 1)
        assert s == enciphered(own, "email:0:") + "@" + (domain if domain == "example.com" else enciphered(stem, "email:0:domain") + "." + last)


def test_numbers(spark):
    rng = random.Random(2)
    cards = ["4111 1111 1111 1111", "4111111111111112"] + ["".join(rng.choices("0123456789", k=k)) for k in range(13, 20)]
    for v, s in made(spark, cards).items():
        a, b = (x.replace(" ", "") for x in (v, s))
        assert a[0] == b[0] and (luhn(a[:-1]) - int(a[-1])) % 10 == (luhn(b[:-1]) - int(b[-1])) % 10 and s != v
        assert b[1:-1] == enciphered(a[1:-1], "card:0:")
    ibans = ["GB82WEST12345698765432", "DE89370400440532013000", "FR1420041010050500013M02606", "DE00370400440532013000"]
    for v, s in made(spark, ibans).items():
        assert s[:2] == v[:2] and s[4:] == enciphered(v[4:], "iban:0:") and (mod97(s[4:] + s[:4]) == 1) == (mod97(v[4:] + v[:4]) == 1)


def ip_class(v):
    a, b, *_ = map(int, v.split("."))
    return a, (a == 172 and 16 <= b < 32) or (a == 169 and b == 254) or (a == 192 and b == 168)


def test_classes_of_addresses_and_numbers(spark):
    rng = random.Random(3)
    ips = sorted({f"{a}.{rng.choice([b, rng.randrange(256)])}.{rng.randrange(256)}.{rng.randrange(256)}" for a, b in [(10, 1), (172, 16), (172, 31), (172, 32), (169, 254), (192, 168), (127, 0), (8, 8), (224, 0)] * 30})
    got = made(spark, ips)
    assert len(set(got.values())) == len(ips) and all(ip_class(v) == ip_class(s) for v, s in got.items())
    assert got[ips[0]].split(".")[1:] == [str(x) for x in turned(map(int, ips[0].split(".")[1:]), [256] * 3, f"ip:0:{ips[0].split('.')[0]}:0")] and ips[0].startswith("10.")
    parts = lambda v: (int(v[:3]) in (0, 666) or int(v[:3]) >= 900, v[4:6] == "00", v[7:] == "0000")
    ssns = sorted({f"{rng.choice([0, 1, 665, 666, 667, 899, 900, 999, rng.randrange(1000)]):03}-{rng.choice([0, 1, 99]):02}-{rng.choice([0, 1, 9999]):04}" for _ in range(300)})
    got = made(spark, ssns)
    assert len(set(got.values())) == len(ssns) and all(parts(v) == parts(s) for v, s in got.items())


def test_names(spark):
    known = {n: g for g, own in pii.NAMES.items() for n in own}
    assert len(known) <= 200
    values = [f"{n} Smith" for n in known]
    got = made(spark, values)
    assert len(set(got.values())) == len(values)
    for v, s in got.items():
        a, b = v.split()[0], s.split()[0]
        assert known[a] == known[b] and a != b
    text = "Dr. Łódź Müller, Frau Änne Öz; Mr Wei-Lin O’Neil. Priya Patel, Иван Фёдоров, the Mary I"
    r = pii.with_surrogates(spark.createDataFrame([(text,)], "text string"), key=KEY).first()
    assert [e.value for e in r.entities] == ["Łódź Müller", "Änne Öz", "Wei-Lin O’Neil", "Priya Patel", "Иван Фёдоров"]
    for e in r.entities:
        assert [c.isupper() for c in e.value] == [c.isupper() for c in e.surrogate] and len(e.value) == len(e.surrogate) or e.value.split()[0] in known
    assert r.text.startswith("Dr. ") and ", Frau " in r.text and r.n_collisions == 0


def test_collisions_are_drawn_again(spark):
    """A corpus that holds its own surrogates."""
    values = [f"{k:03}-12-3456" for k in range(100, 130)]
    first = made(spark, values)
    docs = spark.createDataFrame([(i, v) for i, v in enumerate([*values, *list(first.values())[:10], "a@example.com e@example.com i@example.com o@example.com u@example.com"])], "doc_id long, text string")
    redrawn = pii.redraws(docs, key=KEY)
    assert {r.value for r in redrawn.collect()} >= set(values[:10])
    rows = pii.with_surrogates(docs, key=KEY, redrawn=redrawn).collect()
    pairs = {(e.value, e.surrogate) for r in rows for e in r.entities}
    old, new = {a for a, _ in pairs}, {b for _, b in pairs}
    assert len(pairs) == len(old) == len(new)
    assert {a for a in old & new if "@" not in a} == set()
    assert pii.redraws(docs.where("doc_id = 3"), key=KEY) is None


HOSTILE = ["a@" + "b." * 500_000 + "com", "a." * 300_000 + "@b.com", "A" * 1_000_000, "1-" * 500_000, "Mary " * 200_000, "Mary A" + "a" * 1_000_000, "+1 " * 300_000, "1." * 500_000, "GB82" + "W" * 1_000_000, "(555) " * 160_000, "Mr. " + "É" * 500_000, "f" * 1_000_000, "Mr. Aa Bb " * 50_000]


def test_hostile_texts(spark):
    docs = spark.createDataFrame(list(enumerate(HOSTILE)), "doc_id long, text string").repartition(len(HOSTILE))
    got = {r.doc_id: r.n_entities for r in pii.with_surrogates(docs, key=KEY).select("doc_id", "n_entities", F.length("text")).collect()}
    assert [got[i] for i in (0, 1, 2, 4, 12)] == [1, 0, 0, 100_000, 50_000]


def test_odd_rows(spark):
    rows = [(1, None, 5, "e", "d"), (2, "", 5, "e", "d"), (2, "", 5, "e", "d"), (None, "x 123-45-6789 x", 5, "e", "d"), (4, "x 123-45-6789 x", 5, "e", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_entities long, _e string, _draws string")
    out = pii.with_surrogates(docs, key=KEY, redrawn=pii.redraws(docs, key=KEY))
    assert out.columns == ["doc_id", "text", "_e", "_draws", "entities", "n_entities", "n_collisions"]
    got = sorted((r.text or "", r.text is None, r.n_entities, r.n_collisions, r._e) for r in out.collect())
    assert got[:3] == [("", False, 0, 0, "e")] * 2 + [("", True, 0, 0, "e")] and got[3] == got[4] and got[3][2:] == (1, 0, "e")
    assert pii.with_surrogates(docs.limit(0), key=KEY).count() == 0 and pii.redraws(docs.limit(0), key=KEY) is None
    with pytest.raises(ValueError):
        pii.with_surrogates(docs, key="it's")
