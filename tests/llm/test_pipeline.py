"""The pipeline against the same stages in plain Python, and on odd rows."""

import collections
import hashlib
import re

import corpus_pipeline
from citemill.llm import language_id, mixing
from test_decontaminate import brute as brute_hits
from test_mixing import raked
from test_near_dedup import brute_classes
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = {c: c + 32 for c in range(65, 91)}


def plain(spark, docs, benchmark):
    """docs: rows of doc_id, text, lang, source -> the rows that run() returns, as (doc_id, text, tokens, topic, probability)."""
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    model = language_id.fit(frame.where(~language_id.held_out()), key=F.col("doc_id"))
    known = [(r, model.predict(r["text"])) for r in docs]
    docs = [r for r, (lang, score) in known if lang != "und" and score >= corpus_pipeline.LEAST_SCORE]
    key = lambda x: x.strip(" \t\n\v\f\r").translate(ASCII)
    seen = collections.Counter(k for r in docs for k in {key(x) for x in r["text"].split("\n")})
    docs = [r | {"text": "\n".join(x for x in r["text"].split("\n") if not key(x) or seen[key(x)] < 10)} for r in docs]
    docs.sort(key=lambda r: r["doc_id"])
    of = brute_classes([r["text"] for r in docs])
    docs = [r for i, r in enumerate(docs) if of[i] == i]
    kept = []
    for r, (n, hit, _) in zip(docs, brute_hits([r["text"] for r in docs], benchmark, find=lambda t: WORD.findall(t.translate(ASCII))), strict=True):
        if not hit or 20 * len(hit) < n:
            runs = [g for g in re.findall("1+|0+", "".join("01"[i in hit] for i in range(n)))]
            gone, at = [], 0
            for g in runs:
                if g[0] == "1" and len(g) >= 13:
                    gone.append((at, at + len(g)))
                at += len(g)
            starts = [m.start() for m in WORD.finditer(r["text"].translate(ASCII))] + [len(r["text"])]
            text = r["text"]
            for a, b in reversed(gone):
                text = text[: starts[a]] + text[starts[b] :]
            kept.append(r | {"text": text})
    tokens, cells = {}, collections.Counter()
    for r in kept:
        n, t = len(WORD.findall(r["text"].translate(ASCII))), r["text"]
        topic = "short" if n < 50 else "contact" if "@" in t or "+1 (" in t else "license" if "licensed" in t or "rights reserved" in t else "long" if n >= 1000 else "prose"
        tokens[r["doc_id"]] = n, topic, (r["source"] or mixing.NULL, r["lang"] or mixing.NULL, topic)
        cells[tokens[r["doc_id"]][2]] += n
    targets = []
    for k in range(3):
        sums = collections.Counter()
        for c, n in cells.items():
            sums[c[k]] += n
        targets.append({v: n**mixing.TEMPER for v, n in sums.items() if n})
    share, total = raked(cells, targets), sum(cells.values())
    for r in kept:
        n, topic, cell = tokens[r["doc_id"]]
        p = min(1, mixing.KEEP * total * share[cell] / cells[cell]) if n else 0
        if int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}".encode()).hexdigest()[:8], 16) / 2**32 < p:
            yield r["doc_id"], r["text"], n, topic, round(p, 6)


def test_against_plain(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    benchmark = [(r.item_id, " ".join(WORD.findall(r.text.translate(ASCII)))) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = corpus_pipeline.run(spark, SF)
    got = sorted((r.doc_id, r.text, r.tokens, r.topic, round(r.probability, 6)) for r in out.collect())
    assert got == sorted(plain(spark, docs, benchmark)) and 20 < len(got) < len(docs)
    assert all(r.n_chars == len(r.text) for r in out.collect())


ODD = [(1, None, "en", "s"), (2, "", None, None), (3, "!!", "en", "s"), (None, "a sentence with letters", "en", "s"), (4, "word " * 60_000, "en", None), (4, "word " * 60_000, "en", None), (5, "die und der ein Haus", "de", "s"), (5, "und noch ein Text", "de", "t")]


def test_odd_rows(spark, tmp_path):
    rows = [(*r, None, "x", 1) for r in ODD]
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, Tokens int"
    for name, own in (("some", rows), ("none", rows[:0])):
        spark.createDataFrame(own, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([("1", "x y"), (None, None)], "item_id string, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
        docs = spark.read.parquet(str(tmp_path / name / "documents.parquet"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stage(spark, docs, str(tmp_path / name)).cache()
            assert docs.columns == columns
        left = collections.Counter((r.doc_id, len(r.text)) for r in docs.collect())
        assert left == ({(None, 23): 1, (4, 300_000): 1, (5, 20): 1, (5, 17): 1} if own else {})
        out = corpus_pipeline.run(spark, str(tmp_path / name))
        assert {"doc_id", "text", "node", "tokens", "probability"} <= set(out.columns) and out.count() <= len(left)
