"""License scans by diagonal voting, in SQL functions only.

All rolling word k-grams of a document are hashed; those whose hash is in a small bitmap of the templates' grams are joined with
the template positions (a broadcast of constants), by hash and by the words themselves. A match votes for its diagonal, the
document's position minus the template's. Diagonals of a template that are at most GAP apart are one cluster. The span of a cluster
in the document is verified by aligning it with the whole template, word by word: it is one if the edit distance is at most
1 - COVERAGE of the template's words. Base phrases are templates of one gram, so that each match is a place where the phrase stands.

Templates are given as pairs of a label and a text (whole licenses, say); by default they are TEMPLATES.

Defined results: a null text is empty, with no words, places or labels and score 0; rows that repeat are scanned one by one, those
of equal id as well; an empty table gives no rows; of further columns of the documents none is returned.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, table, word_array, words_of

#: Phrases whose places are counted, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Opening or characteristic sentences of public licenses, with labels.
TEMPLATES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "this work is licensed under cc by 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
GRAM = 3
GAP = 2
COVERAGE = 0.7
BITS = 1 << 16


#: The characters that stand for a template's words when it is aligned; `?` stands for any other word.
_CODES = "".join(chr(c) for c in range(48, 123) if chr(c) not in "?\\'\"") + "".join(map(chr, range(0x4E00, 0x9FFF)))


def grams(templates: list[tuple[str, str]] | None = None) -> list[tuple[int, str, int, str, str, str, bool]]:
    """(template, its label, position, gram, code of the gram, code of the template, base) of every template position."""
    out = []
    known = [(phrase.split(), label, len(phrase.split()), True) for phrase, label in BASE.items()]
    for label, text in TEMPLATES if templates is None else templates:
        words = [w.decode() for w in words_of(text.encode())]
        known.append((words, label, min(GRAM, len(words)), False))
    for t, (words, label, k, base) in enumerate(known):
        if not words:
            raise ValueError(f"a template of {label} has no words")
        codes = {w: _CODES[i] for i, w in enumerate(dict.fromkeys(words))}
        code = "".join(codes[w] for w in words)
        out += [(t, label, i, " ".join(words[i : i + k]), code[i : i + k], code, base) for i in range(len(words) - k + 1)]
    return out


def gram_hash(gram: str) -> int:
    """As xxhash64() has it of the words in turn."""
    h = 42
    for w in gram.split():
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return h - (1 << 64) if h >> 63 else h


def scan(docs: DataFrame, *, templates: list[tuple[str, str]] | None = None, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word (long), base_labels, labels (string), score (double): that of the best span."""
    spark, known = docs.sparkSession, grams(templates)
    held = spark.createDataFrame([(gram_hash(g), t, label, i, g, piece, code, base) for t, label, i, g, piece, code, base in known], "hash long, template int, label string, at int, gram string, piece string, code string, base boolean")
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = word_array(lowered)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), words.alias("w")).withColumn("n_words", F.size("w").cast("long"))
    candidates = []
    for k in sorted({len(x[3].split()) for x in known}):
        bits = [0] * (BITS // 64)
        for g in {x[3] for x in known if len(x[3].split()) == k}:
            slot = gram_hash(g) & (BITS - 1)
            bits[slot >> 6] |= 1 << (slot & 63)
        array = "array(" + ", ".join(f"bigint('{b - (1 << 64) if b >> 63 else b}')" for b in bits) + ")"
        h = f"xxhash64({', '.join(f'w[i + {j}]' for j in range(k))})"
        test = f"shiftright({array}[cast(shiftright(h & {BITS - 1}L, 6) AS int)], cast(h & 63L AS int)) & 1L = 1L".replace("h &", f"{h} &")
        keep = f"filter(if(size(w) >= {k}, sequence(0, size(w) - {k}), array()), i -> {test})"
        candidates.append(f"transform({keep}, i -> named_struct('pos', i, 'hash', {h}, 'gram', array_join(slice(w, i + 1, {k}), ' ')))")
    cand = rows.withColumn("c", F.expr(f"concat({', '.join(candidates)})")).drop("w")
    each = cand.select("doc_id", "row", "n_words", F.explode_outer("c").alias("c")).select("doc_id", "row", "n_words", F.col("c.pos").alias("pos"), F.col("c.hash").alias("hash"), F.col("c.gram").alias("gram"))
    # The templates are constants of the plan, a row for each of their words.
    votes = each.join(F.broadcast(held), ["hash", "gram"], "left").drop("hash", "gram")
    # One exchange: all that follows is by row or finer. A row without a match keeps one vote for nothing.
    votes = votes.withColumn("pos", F.when(F.col("template").isNotNull(), F.col("pos"))).groupBy(*votes.columns).agg(F.count("*").alias("_")).drop("_").repartition(F.col("row"))
    votes = votes.withColumn("diagonal", F.col("pos") - F.col("at"))
    by = Window.partitionBy("row", "template").orderBy("diagonal", "at")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(by) <= GAP, 0).otherwise(1)
    clustered = votes.withColumn("apart", F.when(F.col("base"), 1).otherwise(apart)).withColumn("cluster", F.sum("apart").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    clusters = clustered.groupBy("doc_id", "row", "n_words", "template", "label", "code", "base", "cluster").agg(
        F.collect_set(F.struct("pos", "piece")).alias("m"), F.min("pos").alias("lo"), F.max(F.col("pos") + F.length("piece")).alias("hi")
    )
    at = "map_from_entries(array_distinct(flatten(transform(m, x -> transform(sequence(0, length(x.piece) - 1), j -> struct(x.pos + j, substr(x.piece, j + 1, 1)))))))"
    span = "array_join(transform(sequence(lo, hi - 1), p -> coalesce(element_at(at, p), '?')), '')"
    aligned = f"element_at(transform(array({at}), at -> greatest(0D, 1 - levenshtein({span}, code) / length(code))), 1)"
    judged = clusters.withColumn("share", F.expr(f"CASE WHEN template IS NULL OR hi - lo > 2 * length(code) THEN 0D WHEN base THEN 1D ELSE {aligned} END"))
    judged = judged.withColumn("fits", F.coalesce(F.col("base") | (F.col("share") >= COVERAGE), F.lit(False)))
    labels = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    base = F.col("fits") & F.col("base")
    return judged.groupBy("doc_id", "row", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("lo"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("lo"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("fits")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("fits"), F.col("share"))), F.lit(0.0)).alias("score"),
    ).drop("row")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


_VALUES = ", ".join(f"({t}, '{label}', {i}, '{g}', {len(g.split())}, '{piece}', '{code}', {str(base).lower()})" for t, label, i, g, piece, code, base in grams())
OP8_SQL = rf"""
WITH t AS (SELECT * FROM (VALUES {_VALUES}) AS v(template, label, "at", gram, k, piece, code, base)),
     d AS (SELECT row_number() OVER () AS r, doc_id,
                  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) AS w FROM documents),
     p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
     g AS (SELECT r, i - 1 AS pos, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM p, (SELECT DISTINCT k FROM t) WHERE i + k - 1 <= len(w)),
     v AS (SELECT r, pos, k, template, label, "at", piece, code, base, pos - "at" AS diagonal FROM g JOIN t USING (k, gram)),
     a AS (SELECT *, CASE WHEN NOT base AND diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal, "at") <= {GAP} THEN 0 ELSE 1 END AS apart FROM v),
     c AS (SELECT *, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal, "at" ROWS UNBOUNDED PRECEDING) AS cluster FROM a),
     s AS (SELECT r, template, cluster, label, code, base, min(pos) AS lo, max(pos + k) AS hi FROM c GROUP BY r, template, cluster, label, code, base),
     x AS (SELECT DISTINCT r, template, cluster, pos + j AS q, substr(piece, j::INT + 1, 1) AS ch FROM (SELECT *, unnest(range(k)) AS j FROM c WHERE NOT base)),
     y AS (SELECT r, template, cluster, code, unnest(range(lo, hi)) AS q FROM s WHERE NOT base AND hi - lo <= 2 * length(code)),
     z AS (SELECT r, template, cluster, greatest(0, 1 - levenshtein(string_agg(coalesce(ch, '?'), '' ORDER BY q), any_value(code)) / length(any_value(code))) AS share
           FROM y LEFT JOIN x USING (r, template, cluster, q) GROUP BY r, template, cluster),
     f AS (SELECT s.*, CASE WHEN base THEN 1.0::DOUBLE ELSE z.share END AS share FROM s LEFT JOIN z USING (r, template, cluster) WHERE base OR z.share >= {COVERAGE}),
     o AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(lo) FILTER (WHERE base) AS first_word, max(lo) FILTER (WHERE base) AS last_word,
                  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
           FROM f GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN o USING (r)
"""
