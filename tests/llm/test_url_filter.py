"""Trees against a boosting in plain Python, held-out URLs, and rules on odd URLs."""

import collections
import math
import zlib

import pytest
from pyspark.sql import functions as F

from citemill.llm import url_filter as U

SF = "/root/testdata/sf0.01"


def features(url):
    rest = url[url.index("://") + 3 :] if "://" in url else ""
    host = rest[: min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))].lower()
    path = rest[len(host) :]
    path = path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]
    n = max(len(url), 1)
    return {
        "length": len(url), "depth": path.count("/"), "digit_ratio": sum(c in "0123456789" for c in url) / n,
        "entropy": -sum(k / n * math.log(k / n) for k in collections.Counter(url).values()), "params": url.count("?") + url.count("&") if "?" in url else 0,
        "host_parts": len(host.split(".")), "hyphens": url.count("-"), "suffix": host.rsplit(".", 1)[-1],
    }


def boosted(x, ys, start):
    """x: bins by row; the scores. Trees by splitting rows, not histograms."""
    score = [start] * len(x)

    def grow(own, depth, g, h):
        G, H = sum(g[i] for i in own), sum(h[i] for i in own)
        best, cut = 1e-6, None
        for k in range(len(U.FEATURES)) if depth < U.DEPTH else ():
            for b in sorted({x[i][k] for i in own})[:-1]:
                gl, hl = sum(g[i] for i in own if x[i][k] <= b), sum(h[i] for i in own if x[i][k] <= b)
                gain = gl * gl / (hl + U.L2) + (G - gl) ** 2 / (H - hl + U.L2) - G * G / (H + U.L2)
                if gain > best + 1e-9:
                    best, cut = gain, (k, b)
        if cut is None:
            value = -U.RATE * G / (H + U.L2)
            for i in own:
                score[i] += value
            return
        k, b = cut
        grow([i for i in own if x[i][k] <= b], depth + 1, g, h)
        grow([i for i in own if x[i][k] > b], depth + 1, g, h)

    for _ in range(U.TREES):
        p = [1 / (1 + math.exp(-s)) for s in score]
        grow(range(len(x)), 0, [a - y for a, y in zip(p, ys)], [a * (1 - a) for a in p])
    return score


def test_trees(spark):
    labelled = U.known_words(spark.read.parquet(f"{SF}/pages.parquet")).where("block IS NOT NULL")
    pairs = sorted({(r.url, r.block) for r in labelled.collect()}, key=lambda x: zlib.crc32(x[0].encode()))[:150]
    pairs = [(u, b) for u, b in pairs if (u, not b) not in pairs]
    model = U.fit(U.learned_from(spark.createDataFrame(pairs * 2, "url string, block boolean")))
    label = {u: int(b) for u, b in pairs}
    prior = (sum(label.values()) + 1) / (len(label) + 2)
    asked = model.binned(U.with_features(U.by_rules(spark.createDataFrame(list(label.items()), "url string, y int"))))
    rows = asked.withColumn("s", model.score()).collect()
    want = boosted([[r[f"b_{name}"] for name in U.FEATURES] for r in rows], [r.y for r in rows], math.log(prior / (1 - prior)))
    by = collections.defaultdict(list)
    for u, y in label.items():
        by[features(u)["suffix"]].append(y)
    for r, s in zip(rows, want, strict=True):
        f = features(r.url)
        f["suffix_rate"] = (sum(by[f["suffix"]]) + 2 * prior) / (len(by[f["suffix"]]) + 2)
        assert all(r[name] == pytest.approx(f[name]) for name in U.FEATURES) and r.s == pytest.approx(s, abs=1e-6)
        assert all(r[f"b_{name}"] == sum(r[name] > e for e in model.edges[name]) for name in U.FEATURES)


def test_held_out_urls(spark):
    """Rules and words label them; trees see neither."""
    labelled = U.known_words(spark.read.parquet(f"{SF}/pages.parquet")).where("block IS NOT NULL").withColumn("out", F.crc32("url") % 5 == 0)
    judged = U.judge(labelled.where("out").select("url", "block"), rules=[], labelled=labelled.where("NOT out").select("url", "block"))
    rows = judged.collect()
    right = sum((r.verdict == "block") == r.block for r in rows) / len(rows)
    most = max(sum(r.block for r in rows), sum(not r.block for r in rows)) / len(rows)
    assert len(rows) > 30 and right > most


def test_odd_rows(spark):
    urls = [None, "", "no scheme", "://", "http://A.Example.com/en/x?a=1", "x://example.com?/en/", "http://example.com/en/#q", "http://www.EXAMPLE.com/en/a", "http://a.net/fr/", "http://xnet/fr/", "http://b.com", "http://b.com/" + "a/" * 50_000]
    pages = spark.createDataFrame([(i, u, 7, "h", "p") for i, u in enumerate(urls)] + [(4, urls[4], 7, "h", "p")], "page_id long, url string, length int, Host string, b_depth string")
    out = U.judge(pages)
    assert out.columns == ["page_id", "url", "length", "b_depth", "host", "path", "rule", "verdict", "score"]
    got = {r.page_id: r for r in out.collect()}
    assert all(r.length == 7 and r.verdict in ("allow", "block") and 0 <= r.score <= 1 for r in got.values()) and out.count() == 13
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(11)] == [
        ("", "", None), ("", "", None), ("", "", None), ("", "", None), ("a.example.com", "/en/x", "example.com/en/"), ("example.com", "", None), ("example.com", "/en/", "example.com/en/"),
        ("www.example.com", "/en/a", "www.example.com/en/"), ("a.net", "/fr/", "net/fr/"), ("xnet", "/fr/", None), ("b.com", "", None),
    ]
    assert U.judge(pages.limit(0)).count() == 0
    none = U.judge(pages.where("page_id < 4"), labelled=pages.select("url", F.lit(None).cast("boolean").alias("block")))
    assert {(r.verdict, r.score) for r in none.collect()} == {("allow", 0.0)}
