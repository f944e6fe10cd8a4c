"""Benchmark decontamination with a generalised suffix automaton over words.

Test items are normalised to words and put into one automaton; documents stream their words through it, tracking the longest
suffix that is a run of item words. A run of `window` words of an item (or a whole shorter item) that occurs in a document
marks its words as hit. Documents are cut or rejected by the length of hit spans and their coverage.

Items are taken in blocks of at most `block_words` words, one automaton each, so that what is broadcast is bounded; a longer item is
cut into pieces that overlap by all but one word of a window. Documents are read once for each block; with more than one, the hits
alone are kept, by text, and joined with the documents once. A Python worker builds an automaton once, however many tasks it runs.

Defined results: a null text has no words and is never contaminated; an item without words is ignored; an item without an id counts
among n_items, but not in the list; items of one id are one; repeated rows are judged one by one; an empty test set or table gives
no hits or no rows; further columns pass through, whatever their names, but for those named as the results, which are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORDS_ONLY, binaries, extended, fresh, sliced, stored, table, word_array, words_of

WINDOW = 13
#: A document is contaminated when 1 / COVERAGE of its words or more are hit.
COVERAGE = 20
BLOCK_WORDS = 200_000


class SuffixAutomaton:
    """Of some sequences of words. States are numbers, 0 is the root."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: dict[int, set[str]] = {}
        whole: list[tuple[str, list[int]]] = []
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if not ids:
                continue
            whole.append((item, ids))
            last = 0
            for w in ids:
                last = self._extend(last, w)
        # Which items have an occurrence of a state's words: from the states of the prefixes up the suffix links.
        for item, ids in whole:
            state = 0
            for w in ids:
                state = self.next[state][w]
                at = state
                while at > 0 and item not in ends.setdefault(at, set()):
                    ends[at].add(item)
                    at = self.link[at]
        #: Short items that end here, as (words, item); state -> the state of its last `window` words.
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, ids in whole:
            if len(ids) < window:
                state = 0
                for w in ids:
                    state = self.next[state][w]
                self.short.setdefault(state, []).append((len(ids), item))
        self.items = {s: frozenset(x) for s, x in ends.items()}
        self.least = min((min(len(ids), window) for _, ids in whole), default=0)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = self._state(length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.len.append(length)
        return len(self.len) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        c = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The hit spans (first word, end), in order of their ends and perhaps overlapping, and the items found."""
        if not self.least or len(words) < self.least:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, [-1] * len(words)), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate([[0], ids >= 0, [0]]).astype(np.int8)))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        nxt, link, length, window = self.next, self.link, self.len, self.window
        for lo, hi in zip(known[::2].tolist(), known[1::2].tolist(), strict=True):
            if hi - lo < self.least:
                continue
            state = matched = 0
            for i, w in enumerate(ids[lo:hi].tolist(), lo + 1):
                while state and w not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if w in nxt[state]:
                    state = nxt[state][w]
                    matched += 1
                at = state
                if matched >= window:
                    while length[link[at]] >= window:
                        at = link[at]
                    spans.append((i - window, i))
                    found |= self.items[at]
                    at = link[at]
                while at > 0:
                    for n, item in self.short.get(at, ()):
                        if n <= matched:
                            spans.append((i - n, i))
                            found.add(item)
                    at = link[at]
        return spans, found


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def pieces_of(words: list[bytes], most: int, window: int) -> Iterator[list[bytes]]:
    """Pieces of at most `most` words (at least two windows) with every window of the words in one of them."""
    most, at = max(most, 2 * window), 0
    while words:
        yield words[at : at + most]
        if at + most >= len(words):
            break
        at += most - window + 1


def _dealt(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> tuple[DataFrame, list[int]]:
    """The pieces (item, words, slot) of all items, once each, and the slots at which blocks of at most block_words words end."""
    block_words = max(block_words, 8 * window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True):
                own = [b" ".join(p) for p in pieces_of(words_of(text), block_words // 4, window)]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(own), pa.string()), pa.array(own, pa.binary())], ["item", "words"])

    items = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string"))
    pieces = stored(items.mapInArrow(run, "item string, words binary").distinct().withColumn("h", F.xxhash64("item", "words")))
    n_words = F.size(F.split(F.col("words").cast("string"), " "))
    # Hashes deal pieces into some tens of slots a block; neighbouring slots are put into one block as far as there is room.
    total = pieces.agg(F.sum(n_words)).first()[0] or 0
    slots = 64 * (1 + total // block_words)
    while True:
        sums = pieces.groupBy(F.pmod("h", F.lit(slots)).alias("slot")).agg(F.sum(n_words).alias("words"), F.count("*").alias("pieces")).orderBy("slot").collect()
        if all(r.words <= block_words or r.pieces == 1 for r in sums):
            break
        slots *= 4
    ends, room = [], block_words
    for r in sums:
        if r.words > room and room < block_words:
            ends.append(r.slot)
            room = block_words
        room -= r.words
    return pieces.withColumn("slot", F.pmod("h", F.lit(slots))), [*ends, slots]


_BUILT: dict[str, SuffixAutomaton] = {}


def _built(name: str, build: Callable[[], SuffixAutomaton]) -> SuffixAutomaton:
    """The automaton of that name, which a worker keeps from task to task; one at a time."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = build()
    return _BUILT[name]


_SPANS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
_HITS = "spans array<struct<lo:int,hi:int>>, items array<string>"


def _in_order(items) -> list[str | None]:
    return sorted(items, key=lambda x: (x is None, x or ""))


def hit_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
    cut: int | None = None,
) -> DataFrame:
    """docs with n_words (long), spans (array of [first word, end) structs, merged) and items (sorted array of strings). cut: the
    texts without spans of so many words, as by without_spans(), but with one Python worker a task where the items are one block."""
    sc = docs.sparkSession.sparkContext
    pieces, ends = _dealt(benchmark, item_col, item_text_col, window, block_words)
    out = docs.select(*[c for c in docs.columns if c.lower() not in ("n_words", "spans", "items")])
    held = []
    for lo, hi in zip([0, *ends], ends):
        own = pieces.where((F.col("slot") >= lo) & (F.col("slot") < hi)).orderBy("item", "words").collect()
        held.append((uuid.uuid4().hex, sc.broadcast([(r.item, bytes(r.words).split()) for r in own])))
    if len(held) == 1:
        return _scanned(out, text_col, *held[0], window, cut)
    key = fresh("_key", out.columns)
    found = None
    for name, items in held:
        hits = _hits(out.select(F.md5(text_col).alias("key"), text_col), name, items, window)
        found = hits if found is None else found.unionByName(hits)
    by = found.groupBy("key").agg(F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    by = by.mapInArrow(_merged_hits, f"{key} string, {_HITS}")
    whole = out.withColumn(key, F.md5(text_col)).join(by, key, "left").withColumn("n_words", F.size(word_array(F.col(text_col))).cast("long"))
    empty = {"spans": "array<struct<lo:int,hi:int>>", "items": "array<string>"}
    whole = whole.select(*out.columns, "n_words", *[F.coalesce(c, F.array().cast(t)).alias(c) for c, t in empty.items()])
    return whole if cut is None else without_spans(whole, text_col=text_col, min_words=cut)


def _merged_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[{"lo": a, "hi": b} for a, b in merged([(x["lo"], x["hi"]) for x in own])] for own in batch.column(1).to_pylist()]
        items = [_in_order(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))], batch.schema.names)


def _hits(texts: DataFrame, name: str, held, window: int) -> DataFrame:
    """texts (key, text) -> key, spans, items of those with hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _built(name, lambda: SuffixAutomaton(held.value, window))
        for batch in sliced(batches):
            keys, spans, items = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), strict=True):
                hit, found = automaton.scan(words_of(text))
                if hit:
                    keys.append(key)
                    spans.append([{"lo": a, "hi": b} for a, b in merged(hit)])
                    items.append(_in_order(found))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))], ["key", "spans", "items"])

    return texts.mapInArrow(run, f"key string, {_HITS}")


def _scanned(docs: DataFrame, text_col: str, name: str, held, window: int, cut: int | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _built(name, lambda: SuffixAutomaton(held.value, window))
        for batch in sliced(batches):
            n_words, spans, items, texts = [], [], [], []
            for text in binaries(batch.column(text_col)):
                words = words_of(text)
                hit, found = automaton.scan(words)
                n_words.append(len(words))
                spans.append([{"lo": a, "hi": b} for a, b in merged(hit)])
                items.append(_in_order(found))
                if cut is not None:
                    texts.append(_cut(text, spans[-1], cut))
            own = {c: batch.column(c) for c in batch.schema.names}
            if cut is not None:
                own[text_col] = pa.array(texts, pa.binary()).cast(pa.string())
            columns = [pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*own.values(), *columns], [*own, "n_words", "spans", "items"])

    return docs.mapInArrow(run, extended(docs.schema, n_words="long", spans="array<struct<lo:int,hi:int>>", items="array<string>"))


def judged(docs: DataFrame, benchmark: DataFrame, *, coverage: int = COVERAGE, **options) -> DataFrame:
    """hit_spans() with n_hit, n_items (long) and contaminated: words are hit, and at least 1 / coverage of all."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["hi"] - s["lo"]).cast("long"))
    return (
        hit_spans(docs, benchmark, **options)
        .withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(coverage) * F.col("n_hit") >= F.col("n_words")))
    )


def _cut(text: bytes | None, spans: list[dict] | None, min_words: int) -> bytes | None:
    spans = [s for s in spans or [] if s["hi"] - s["lo"] >= min_words]
    if text is None or not spans:
        return text
    inside = np.frombuffer(text.translate(WORDS_ONLY), np.uint8) != 32
    starts = np.flatnonzero(np.diff(np.concatenate([[0], inside]).astype(np.int8)) == 1)
    edge = np.append(starts, len(text))
    parts, at = [], 0
    for s in spans:
        parts.append(text[at : edge[s["lo"]]])
        at = int(edge[s["hi"]])
    return b"".join([*parts, text[at:]])


def without_spans(judged_docs: DataFrame, *, text_col: str = "text", min_words: int = WINDOW) -> DataFrame:
    """The texts with every hit span of at least min_words words cut out, up to the word after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [_cut(t, s, min_words) for t, s in zip(binaries(batch.column(text_col)), batch.column("spans").to_pylist(), strict=True)]
            columns = {c: batch.column(c) for c in batch.schema.names} | {text_col: pa.array(texts, pa.binary()).cast(pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    return judged_docs.mapInArrow(run, judged_docs.schema)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP2_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  coalesce(regexp_extract_all({_LOWER_SQL}, '{"[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+".replace(chr(92) * 2, chr(92))}'), []) AS ws FROM documents),
     b AS (SELECT item_id::VARCHAR AS item, coalesce(regexp_extract_all({_LOWER_SQL}, '{"[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+".replace(chr(92) * 2, chr(92))}'), []) AS ws FROM benchmark),
     bw AS (SELECT DISTINCT item, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS g, least(len(ws), 13) AS n
            FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
     ns AS (SELECT DISTINCT n FROM bw),
     p AS (SELECT r, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, ns WHERE len(ws) >= n),
     h AS (SELECT p.r, p.i, bw.n, bw.item FROM p JOIN bw ON p.n = bw.n AND bw.g = array_to_string(p.ws[p.i:p.i + p.n - 1], ' ')),
     c AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS w FROM h) GROUP BY r),
     t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
