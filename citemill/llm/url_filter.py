"""URL filters: rules, and gradient-boosted trees on lexical features where no rule fits, in DataFrame functions only.

Labelled URLs are given (url, block); by default they are those that rules judge and those whose hosts carry known words. Trees are
trained on at most MAX_TRAIN distinct labelled URLs, those with the smallest hashes, and grown level by level from histograms of
gradients: one grouped aggregation a level over binned features, at most (leaves x features x bins) rows of which come to the
driver. They become one column expression. The suffix statistic is the rate of blocked URLs under a host's last label; the
MAX_SUFFIXES most frequent labels have their own, all others the rate of all.

Defined results: a null URL, or one without `://`, has an empty host and path; with no labelled URL every verdict without a rule is
allow; a URL labelled both ways counts as blocked; rows that repeat are judged alike and learned once; an empty table gives no rows;
further columns pass through judge(), whatever their names, but for those named as the results, which are replaced.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: (rule, verdict): host and path; the longest that fits wins.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
#: Host labels that mark a URL as labelled where no rule fits it. Parts of a label are split at hyphens.
BLOCK_WORDS = "ad ads adserver affiliate banner casino click farm pills porn promo spam track tracker tracking".split()
ALLOW_LABELS = "www blog m docs news en de fr es".split()
MAX_TRAIN = 20_000
TREES, DEPTH, BINS, RATE, L2 = 8, 3, 8, 0.3, 1.0
MAX_SUFFIXES = 100
FEATURES = ["length", "depth", "digit_ratio", "entropy", "params", "host_parts", "hyphens", "suffix_rate"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    rest = F.when(u.contains("://"), F.expr("substr({0}, instr({0}, '://') + 3)".replace("{0}", "coalesce(url, '')"))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def by_rules(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """pages (with url) and host, path, rule, rule_verdict."""
    host, path = host_and_path(F.col("url"))
    rule = verdict = F.lit(None).cast("string")
    for r, v in sorted(rules, key=lambda x: len(x[0])):
        h, p = r[: r.index("/")], r[r.index("/") :]
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return pages.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "rule_verdict": verdict})


def with_features(df: DataFrame) -> DataFrame:
    u = F.coalesce(F.col("url"), F.lit(""))
    n = F.greatest(F.length(u), F.lit(1))
    entropy = F.expr(
        "-aggregate(array_distinct(split(coalesce(url, ''), '')), 0D, (t, c) -> t + if(c = '', 0D, "
        "(length(url) - length(replace(url, c, ''))) / length(url) * ln((length(url) - length(replace(url, c, ''))) / length(url))))"
    )
    return df.withColumns(
        {
            "length": F.length(u).cast("double"),
            "depth": F.regexp_count(F.col("path"), F.lit("/")).cast("double"),
            "digit_ratio": F.regexp_count(u, F.lit("[0-9]")) / n,
            "entropy": F.coalesce(entropy, F.lit(0.0)),
            "params": F.when(u.contains("?"), F.regexp_count(u, F.lit("[?&]"))).otherwise(0).cast("double"),
            "host_parts": F.size(F.split("host", "[.]")).cast("double"),
            "hyphens": F.regexp_count(u, F.lit("-")).cast("double"),
            "suffix": F.substring_index("host", ".", -1),
        }
    )


class Boosted:
    """The trees, as nested splits (feature, bin, left, right) or leaf values, and what turns a URL into bins."""

    def __init__(self, suffixes: dict[str, float], prior: float, edges: dict[str, list[float]], start: float):
        self.suffixes, self.prior, self.edges, self.start, self.trees = suffixes, prior, edges, start, []

    def rate(self) -> Column:
        if not self.suffixes:
            return F.lit(self.prior)
        pairs = F.create_map(*[F.lit(x) for kv in self.suffixes.items() for x in kv])
        return F.coalesce(F.element_at(pairs, F.col("suffix")), F.lit(self.prior))

    def binned(self, df: DataFrame) -> DataFrame:
        df = df.withColumn("suffix_rate", self.rate())
        bins = {}
        for f in FEATURES:
            b = F.lit(0)
            for e in self.edges[f]:
                b = b + F.when(F.col(f) > e, 1).otherwise(0)
            bins[f"b_{f}"] = b
        return df.withColumns(bins)

    @staticmethod
    def value(tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        feature, cut, left, right = tree
        return F.when(F.col(f"b_{feature}") <= cut, Boosted.value(left)).otherwise(Boosted.value(right))

    def score(self) -> Column:
        """The log-odds of block."""
        return sum((self.value(t) for t in self.trees), F.lit(self.start))


def learned_from(labelled: DataFrame, rules: list[tuple[str, str]] = RULES, max_train: int = MAX_TRAIN) -> DataFrame:
    """labelled (url, block) -> features and y of at most max_train distinct URLs, as a stored table."""
    each = labelled.where("url IS NOT NULL AND block IS NOT NULL").groupBy("url").agg(F.max(F.col("block").cast("int")).alias("y"))
    some = each.orderBy(F.xxhash64("url"), "url").limit(max_train)
    return stored(with_features(by_rules(some, rules)).select(*[f for f in FEATURES if f != "suffix_rate"], "suffix", "y"))


def fit(sample: DataFrame) -> Boosted | None:
    """sample: as of learned_from(). None without rows."""
    n, blocked = sample.agg(F.count("*"), F.sum("y")).first()
    if not n:
        return None
    prior = (blocked + 1) / (n + 2)
    by = sample.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("y").alias("y")).orderBy(F.desc("n"), "suffix").limit(MAX_SUFFIXES).collect()
    model = Boosted({r.suffix: (r.y + 2 * prior) / (r.n + 2) for r in by}, prior, {}, log(prior / (1 - prior)))
    quantiles = [F.percentile_approx(f, F.array(*[F.lit(k / BINS) for k in range(1, BINS)]), 1000).alias(f) for f in FEATURES]
    found = sample.withColumn("suffix_rate", model.rate()).agg(*quantiles).first()
    model.edges = {f: sorted(set(found[f])) for f in FEATURES}
    bins = [f"b_{f}" for f in FEATURES]
    # Rows that fall into the same bins are one row with a count.
    counted = stored(model.binned(sample).groupBy(*bins, "y").agg(F.count("*").cast("double").alias("n")).coalesce(4))
    for _ in range(TREES):
        p = 1 / (1 + F.exp(-model.score()))
        scored = counted.withColumns({"g": F.col("n") * (p - F.col("y")), "h": F.col("n") * p * (1 - p)})
        model.trees.append(_grown(scored))
    return model


def _grown(scored: DataFrame):
    """One tree on gradients g and h: nodes are dicts until they are done."""
    root: dict = {"path": []}
    level = [root]
    kinds = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in FEATURES])
    for _ in range(DEPTH):
        node = F.lit(None).cast("int")
        for k, own in enumerate(level):
            inside = F.lit(True)
            for f, cut, right in own["path"]:
                inside = inside & ((F.col(f"b_{f}") > cut) if right else (F.col(f"b_{f}") <= cut))
            node = F.when(inside, k).otherwise(node)
        each = scored.select(node.alias("node"), "g", "h", F.explode(kinds).alias("x")).where("node IS NOT NULL")
        got = each.groupBy("node", "x.f", "x.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        grown = []
        for k, own in enumerate(level):
            mine = sorted(((r.f, r.b, r.g, r.h) for r in got if r.node == k))
            g, h = (sum(r[i] for r in mine if r[0] == FEATURES[0]) for i in (2, 3))
            own["leaf"] = -RATE * g / (h + L2)
            best: tuple = (1e-6, None)
            for f in FEATURES:
                gl = hl = 0.0
                for _, b, rg, rh in [r for r in mine if r[0] == f][:-1]:
                    gl, hl = gl + rg, hl + rh
                    gain = gl * gl / (hl + L2) + (g - gl) ** 2 / (h - hl + L2) - g * g / (h + L2)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, b, gl, hl))
            if best[1]:
                f, b, gl, hl = best[1]
                own["split"] = (f, b, *({"path": [*own["path"], (f, b, right)], "leaf": -RATE * x / (y + L2)} for right, x, y in ((False, gl, hl), (True, g - gl, h - hl))))
                grown += own["split"][2:]
        level = grown
        if not level:
            break

    def closed(x: dict):
        return (x["split"][0], x["split"][1], closed(x["split"][2]), closed(x["split"][3])) if "split" in x else float(x["leaf"])

    return closed(root)


def known_words(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """(url, block) of the URLs that the rules judge, or whose host has one of BLOCK_WORDS or begins with one of ALLOW_LABELS."""
    full, parts = by_rules(pages.select("url"), rules), F.split("host", "[.-]")
    marked = F.when(F.arrays_overlap(parts, F.array(*map(F.lit, BLOCK_WORDS))), True).when(F.get(parts, F.lit(0)).isin(ALLOW_LABELS), False)
    return full.select("url", F.coalesce(F.col("rule_verdict") == "block", marked).alias("block"))


def judge(pages: DataFrame, *, rules: list[tuple[str, str]] = RULES, labelled: DataFrame | None = None, max_train: int = MAX_TRAIN) -> DataFrame:
    """pages with host, path, rule, verdict and score (double, of block). labelled (url, block): known_words() unless given."""
    results = ("host", "path", "rule", "verdict", "score")
    own = [c for c in pages.columns if c.lower() not in results]
    model = fit(learned_from(known_words(pages, rules) if labelled is None else labelled, rules, max_train))
    # The caller's columns travel in one of their own, so that no name of theirs meets a feature's.
    full = with_features(by_rules(pages.select(F.struct(*own).alias("_row"), "url"), rules))
    score = F.lit(0.0)
    if model is not None:
        full, score = model.binned(full), 1 / (1 + F.exp(-model.score()))
    verdict = F.coalesce("rule_verdict", F.when(score >= 0.5, "block").otherwise("allow"))
    return full.select(*[F.col("_row")[c].alias(c) for c in own], "host", "path", "rule", verdict.alias("verdict"), F.round(score, 9).alias("score"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op5_url_filter SQL can express."""
    return op5_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict"))


_CASES = [(r, v, r[: r.index("/")], r[r.index("/") :]) for r, v in sorted(RULES, key=lambda x: -len(x[0]))]
_CASE_SQL = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{{k}}}'" for k, (_, _, h, p) in enumerate(_CASES))
URL_RULES_SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
     p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path, CASE {_CASE_SQL.format(*[c[0] for c in _CASES])} END AS rule, CASE {_CASE_SQL.format(*[c[1] for c in _CASES])} END AS rule_verdict FROM p
"""
