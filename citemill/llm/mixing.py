"""Mixing sources to target weights by iterative proportional fitting, in SQL functions only.

Tokens are summed by cell (source, language, topic). Cell weights are raked in turn to the targets of each marginal until the
largest deviation falls below `tolerance`; then each cell's documents are sampled with a calibrated probability, and carry the
weight that makes up for probabilities cut at 1. Targets are given by marginal, as weights of its values; a marginal without them
has the corpus's own shares to the power `temper`. Texts are split into words once; what that gives is stored.

The table of cells has one row per combination that occurs; it is raked in one partition and broadcast only up to MAX_CELLS rows,
beyond that by exchanges and a join. Targets that no weights of the cells meet (those of values that never occur together) don't
converge: after MAX_ROUNDS the deviation is given as a warning, or as an error where `strict` is set.

Defined results: a null source, language or topic is a value of its own (None among the targets); a value that the targets of its
marginal don't name has weight 0, and a target whose value doesn't occur is left out; a null text has no tokens and topic `short`;
cells without tokens have probability 0; rows that repeat share their fate (it depends on doc_id and seed alone); an empty table
gives no rows; further columns pass through, whatever their names, but for those named as the results, which are replaced.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, fresh, stored, table, word_array

DIMS = ("source", "lang", "topic")
TEMPER = 0.5
KEEP = 0.5
SEED = "mix-1"
TOLERANCE = 1e-10
MAX_ROUNDS = 240
ROUNDS_AT_ONCE = 6
MAX_CELLS = 20_000
#: Fixed value: stands for null among the values of a marginal.
NULL = "∅"


def topic(text: Column, tokens: Column) -> Column:
    """A coarse topic by the surface of a text."""
    return (
        F.when(F.coalesce(tokens, F.lit(0)) < 50, "short")
        .when(text.contains("@") | text.contains("+1 ("), "contact")
        .when(text.contains("licensed") | text.contains("rights reserved"), "license")
        .when(tokens >= 1000, "long")
        .otherwise("prose")
    )


def weighed(docs: DataFrame, names: dict[str, str], *, text_col: str = "text") -> DataFrame:
    """docs with tokens (long) and, unless there is one, topic; the marginals without nulls under their names."""
    out = docs.withColumn("tokens", F.size(word_array(F.col(text_col))).cast("long"))
    if "topic" not in out.columns:
        out = out.withColumn("topic", topic(F.col(text_col), F.col("tokens")))
    return out.withColumns({name: F.coalesce(F.col(d).cast("string"), F.lit(NULL)) for d, name in names.items()})


def rake(cells: DataFrame, dims: list[str], *, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, tolerance: float = TOLERANCE, one_part: bool = True, strict: bool = False) -> DataFrame:
    """cells (dims, tokens) with share (double): the raked share of each cell. targets: weights by value, of some dims."""
    over = {d: Window.partitionBy(d) for d in dims}
    df = cells.where("tokens > 0")
    df = df.coalesce(1) if one_part else df
    for d in dims:
        own = (targets or {}).get(d)
        if own is None:
            weight = lambda sums: F.pow(sums.cast("double"), F.lit(temper))
        else:
            pairs = F.create_map(*[F.lit(x) for value, w in own.items() for x in (NULL if value is None else value, float(w))])
            weight = lambda sums, pairs=pairs, d=d: F.coalesce(F.element_at(pairs, F.col(d)), F.lit(0.0))
        total = df.groupBy(d).agg(F.sum("tokens").alias("s")).agg(F.sum(weight(F.col("s")))).first()[0]
        if total is not None and not total > 0:
            raise ValueError(f"no value of {d} that occurs has a target")
        df = df.withColumn(f"t_{d}", weight(F.sum("tokens").over(over[d])) / F.lit(total or 1.0))
    df = stored(df.withColumn("share", F.col("tokens").cast("double")))
    worst = 0.0
    for _ in range(0, MAX_ROUNDS, ROUNDS_AT_ONCE):
        for _ in range(ROUNDS_AT_ONCE):
            for d in dims:
                df = df.withColumn("share", F.coalesce(F.try_divide(F.col("share") * F.col(f"t_{d}"), F.sum("share").over(over[d])), F.lit(0.0)))
        df = stored(df.coalesce(1) if one_part else df)
        off = [F.max(F.abs(F.col(f"s_{d}") - F.col(f"t_{d}"))).alias(d) for d in dims]
        worst = max(x or 0 for x in df.withColumns({f"s_{d}": F.sum("share").over(over[d]) for d in dims}).agg(*off).first())
        if worst < tolerance:
            break
    else:
        said = f"after {MAX_ROUNDS} rounds a share is {worst:.3g} off its target: the targets can't all be met, or not so closely"
        if strict:
            raise ValueError(said)
        warnings.warn(said, RuntimeWarning, stacklevel=2)
    return df.drop(*[f"t_{d}" for d in dims])


def mixed(docs: DataFrame, *, targets: dict[str, dict[str | None, float]] | None = None, doc_id: str = "doc_id", text_col: str = "text", keep: float = KEEP, temper: float = TEMPER, seed: str = SEED, text_out: bool = False, strict: bool = False) -> DataFrame:
    """docs with tokens, topic, probability, weight (double) and sampled (boolean). targets: by marginal (source, lang, topic), the
    weight of each value; keep: the share of all tokens to sample."""
    if unknown := set(targets or {}) - set(DIMS):
        raise ValueError(f"no such marginals: {sorted(unknown)}")
    own = [c for c in docs.columns if c.lower() not in ("tokens", "probability", "weight", "sampled")]
    names = {d: fresh(f"m_{d}", own) for d in DIMS}
    full = weighed(docs.select(*own), names, text_col=text_col)
    full = stored(full if text_out else full.drop(text_col))
    dims = list(names.values())
    cells = stored(full.groupBy(*dims).agg(F.sum("tokens").alias("tokens")))
    few = cells.count() <= MAX_CELLS
    shares = rake(cells, dims, targets={names[d]: own for d, own in (targets or {}).items()}, temper=temper, one_part=few, strict=strict)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    ratio = F.lit(keep * total) * F.col("share") / F.col("tokens")
    plan = shares.select(*dims, F.least(ratio, F.lit(1.0)).alias("probability"), F.greatest(ratio, F.lit(1.0)).alias("weight"))
    # Bounded by MAX_CELLS, counted above.
    out = full.join(F.broadcast(plan) if few else plan, dims, "left").withColumns({"probability": F.coalesce("probability", F.lit(0.0)), "weight": F.coalesce("weight", F.lit(1.0))})
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / 2**32
    return out.withColumn("sampled", draw < F.col("probability")).drop(*dims)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixed(docs).select("doc_id", "tokens", "topic", F.round("probability", 6).alias("probability"), F.round("weight", 6).alias("weight"), "sampled")


def _raked_sql() -> str:
    step, cols = "SELECT k, source, lang, topic, tokens, ts, tl, tt, share FROM f", "k + 1 AS k, source, lang, topic, tokens, ts, tl, tt"
    for d, t in (("source", "ts"), ("lang", "tl"), ("topic", "tt")):
        step = f"SELECT k, source, lang, topic, tokens, ts, tl, tt, share * {t} / sum(share) OVER (PARTITION BY {d}) AS share FROM ({step})"
    return f"SELECT {cols}, share FROM ({step}) WHERE k < 90"


OP6_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, text, coalesce(source, '{NULL}') AS source, coalesce(lang, '{NULL}') AS lang,
                  coalesce(len(regexp_extract_all(lower(text), '{WORD}')), 0) AS tokens FROM documents),
     x AS (SELECT *, CASE WHEN tokens < 50 THEN 'short' WHEN contains(text, '@') OR contains(text, '+1 (') THEN 'contact'
                          WHEN contains(text, 'licensed') OR contains(text, 'rights reserved') THEN 'license' WHEN tokens >= 1000 THEN 'long' ELSE 'prose' END AS topic FROM w),
     c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM x GROUP BY ALL HAVING sum(tokens) > 0),
     s1 AS (SELECT source, sqrt(sum(tokens)) AS t FROM c GROUP BY source), s2 AS (SELECT lang, sqrt(sum(tokens)) AS t FROM c GROUP BY lang), s3 AS (SELECT topic, sqrt(sum(tokens)) AS t FROM c GROUP BY topic),
     f AS (SELECT 0 AS k, c.source, c.lang, c.topic, tokens, s1.t / (SELECT sum(t) FROM s1) AS ts, s2.t / (SELECT sum(t) FROM s2) AS tl, s3.t / (SELECT sum(t) FROM s3) AS tt, tokens AS share
           FROM c JOIN s1 USING (source) JOIN s2 USING (lang) JOIN s3 USING (topic)
           UNION ALL {_raked_sql()}),
     p AS (SELECT source, lang, topic, {KEEP} * (SELECT sum(tokens) FROM c) * share / tokens AS ratio FROM f WHERE k = 90)
SELECT doc_id, x.tokens::BIGINT AS tokens, x.topic, round(least(coalesce(ratio, 0), 1), 6)::DOUBLE AS probability, round(greatest(coalesce(ratio, 1), 1), 6)::DOUBLE AS weight,
       ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296 < least(coalesce(ratio, 0), 1) AS sampled
FROM x LEFT JOIN p USING (source, lang, topic)
"""
