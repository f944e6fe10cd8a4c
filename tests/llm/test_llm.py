"""The training-data operators against brute force and on odd inputs."""

import collections
import re

import duckdb
import numpy as np
import pytest

from citemill.llm import decontaminate, fuzzy_hash, language_id, license_scan, line_dedup, mixing, near_dedup, pii, repeats, url_filter
from citemill.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b", "en", "s", 3), (3, "a b", "en", "s", 3), (None, "!!", "de", None, 2), (4, "word " * 50_000, "fr", "s", 250_000)]


def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(Q.oracle_sql()[name])
    got = Q.queries()[name](spark, SF).select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_odd_rows_and_empty_tables(spark):
    """All operators that return a row for each document, on the same odd rows; their own tests have the values."""
    b = spark.createDataFrame([("1", "x y"), ("2", None)], "item_id string, text string")
    for docs, n in ((odd(spark), len(ODD)), (spark.createDataFrame([], DOCS), 0)):
        assert pii.with_surrogates(docs, key="k").count() == n
        assert decontaminate.judged(docs, b).count() == n
        assert fuzzy_hash.fingerprints(docs).count() == n
        model = language_id.fit(docs.select("doc_id", "text", "lang"), key=docs.doc_id)
        assert language_id.predict(docs, model).count() == n
        assert mixing.mixed(docs).count() == n
        assert line_dedup.dedup_lines(docs).count() == n
        assert license_scan.scan(docs).count() == n
        assert near_dedup.classes(docs).count() == n
        got = sorted((str(r.doc_id), bytes(r.text), r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(docs).collect())
        want = [("1", b"", 0, 0, 0), ("2", b"", 0, 0, 0), ("3", b"a b", 3, 0, 0), ("3", b"a b", 3, 0, 0), ("4", b"", 250_000, 250_000, 1), ("None", b"!!", 2, 0, 0)]
        assert got == (want if n else [])


def test_automaton():
    items = [("1", [b"a", b"b", b"c"]), ("2", [b"x"] * 20), ("3", [b"b", b"c"])]
    spans, found = decontaminate.SuffixAutomaton(items, 13).scan([b"z", b"a", b"b", b"c"] + [b"x"] * 13)
    assert found == {"1", "2", "3"} and decontaminate.merged(spans) == [[1, 17]]


def test_held_out_languages(spark):
    got = {r.doc_id: r for r in Q.queries()["op4_language_id"](spark, SF).collect()}
    rows = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if got[r.doc_id].held_out and r.lang and got[r.doc_id].lang_pred != "und"]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in rows]) > 0.9


def test_languages_are_learned_alike(spark):
    """A language with one text in hundreds, one id and text repeated many times, rows without text or language."""
    say = {"de": "der und die nicht ein Wort", "en": "the and that is a word", "fr": "le et la une pas du mot"}
    rows = [(7, say["en"], "en", "x")] * 2000 + [(i, f"{say['en']} {i}", "en", "x") for i in range(1500)] + [(i, f"{say['de']} {i}", "de", "x") for i in range(300)]
    rows += [(5, f"{say['fr']} {c}", "fr", "x") for c in "abc"] + [(8, None, "en", "x"), (9, "text", None, "x"), (None, "", "de", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = collections.Counter(r.lang for r in language_id.sample(docs, docs.doc_id, max_train=600).collect())
    assert got["de"] == 200 and got["fr"] == 3 and 150 <= got["en"] <= 200  # repeats take room before they go
    model = language_id.fit(docs, key=docs.doc_id, max_train=600)
    asked = spark.createDataFrame([(1, "le mot et la", "x"), (2, "das Wort ist nicht die", "x"), (3, "the word that is", "x"), (4, "123 !", "x"), (5, None, "x"), (6, "", "x")], "doc_id long, text string, Score string")
    out = language_id.predict(asked, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    pred = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert [pred[i][0] for i in range(1, 7)] == ["fr", "de", "en", "und", "und", "und"] and pred[4][1] == 0 < pred[1][1] <= 1


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, (5000, 2))
    keys[:2000, 0] = keys[0, 0]  # keys that share one half
    assert sorted(line_dedup.PerfectHash.build(keys).index(keys)) == list(range(5000))


@pytest.mark.parametrize("group_bytes", [line_dedup.GROUP_BYTES, 400, 1])
def test_lines(spark, group_bytes):
    rng = np.random.default_rng(6)
    lines = [f" Line {i} \t" if i % 2 else f"line {i - 1}".upper() for i in range(60)] + ["", "  ", "é\u00a0", "\r"]
    texts = [None, "", "\n", "\n" * 50, "x " * 40_000 + "\nline 1"] + ["\n".join(rng.choice(lines, rng.integers(1, 30))) for _ in range(60)]
    texts += [texts[9]] * 12
    docs = spark.createDataFrame([(i, t, 1, "d", 2) for i, t in enumerate(texts)], "doc_id long, text string, n_lines int, _drop string, _key int")
    out = line_dedup.dedup_lines(docs, group_bytes=group_bytes, shard_keys=4)
    assert out.columns == ["doc_id", "text", "_drop", "_key", "n_lines", "n_dropped"]
    key = lambda x: x.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    seen = collections.Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    for t, r in zip(texts, out.orderBy("doc_id").collect(), strict=True):
        own = (t or "").split("\n")
        kept = [x for x in own if not key(x) or seen[key(x)] < 10]
        assert (r.text, r.n_lines, r.n_dropped, r._drop) == ("\n".join(kept), len(own), len(own) - len(kept), "d")
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def _without_repeats(texts):
    """By counting all windows."""
    seen = collections.Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    for t in texts:
        inside = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                inside[i : i + 200] = True
        yield np.frombuffer(t, np.uint8)[~inside].tobytes(), int(inside.sum())


@pytest.mark.parametrize("hot", [repeats.HOT_SEGMENTS, 1])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: (bytes(r.text), r.n_removed) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[r.doc_id] for r in rows] == list(_without_repeats([(r.text or "").encode() for r in rows]))


@pytest.mark.parametrize("hot", [1024, 40, 3])
def test_passage_between_many_contexts(spark, monkeypatch, hot):
    """One passage in 300 texts, cut off at every place, with own bytes or those of another around it."""
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    rng = np.random.default_rng(4)
    letters = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    passage, sides, texts = letters(420), [letters(150) for _ in range(6)], []
    for _ in range(300):
        a, b = sorted(rng.integers(0, 420, 2))
        left = letters(60) + sides[rng.integers(6)][-rng.integers(1, 150) :]
        texts.append(left + passage[a:b] + sides[rng.integers(6)][: rng.integers(1, 150)] + letters(60))
    texts += [b"ab" * 300, b"a" * 450, b"a" * 200]
    docs = spark.createDataFrame([(i, t.decode(), "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, R1 string, spans int")
    out = repeats.remove_repeats(docs)
    assert out.columns == ["doc_id", "text", "R1", "spans", "n_bytes", "n_removed", "n_spans"]
    assert [(bytes(r.text), r.n_removed) for r in out.orderBy("doc_id").collect()] == list(_without_repeats(texts))


def test_components(spark):
    rng = np.random.default_rng(3)
    names = rng.integers(-(2**63), 2**63 - 1, 400)
    edges = [(int(names[i]), int(names[j])) for i, j in rng.integers(0, 400, (260, 2))]
    edges += [(int(a), int(b)) for a, b in zip(names[:60], names[1:61])] + [edges[0], edges[0][::-1]]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    loops = {a for a, b in edges if a == b} - {n for a, b in edges if a != b for n in (a, b)}
    got = near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {n: r for n, r in root.items() if n not in loops} and len(got) == len(root) - len(loops)
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0
