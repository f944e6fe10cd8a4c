"""Line deduplication with a sharded minimal perfect hash.

The distinct lines that reach the document count are hashed to 128 bits. They place a line in a shard and, in the shard's minimal
perfect hash, at an index; the second 64 of them are kept at that index as a fingerprint next to the count. Documents probe these
arrays; their lines are never shuffled again or joined. Shards are probed in groups of at most `group_bytes`, so that what is
broadcast is bounded. With more shards than fit into one group, texts are hashed once; a pass for each group reads only the hashes
and keeps only marks of the texts that have such lines, which are joined with the documents once.

Defined results: a null or empty text is one empty line and stays as it is (null: ''); rows that repeat count as documents of their
own; an empty table gives no rows; further columns pass through, whatever their names, but for those named as the results, which
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, binaries, extended, fresh, mix64, sliced, stored, table

MIN_DOCS = 10
SHARD_KEYS = 100_000
GROUP_BYTES = 48 << 20
SPACE = b" \t\n\v\f\r"
_HASHES = pa.schema([("h1", pa.int64()), ("h2", pa.int64())])


def line_keys(text: bytes | None) -> list[bytes]:
    return [x.strip(SPACE) for x in (text or b"").translate(LOWER).split(b"\n")]


def _hashed(keys) -> np.ndarray:
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(k) for k in keys]), dtype="<i8").reshape(-1, 2)


def line_hashes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(h1, h2): the hash of each distinct line key of each document, empty keys left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keys: list[bytes] = []
            for text in binaries(batch.column(0)):
                own = set(line_keys(text))
                own.discard(b"")
                keys.extend(own)
            h = _hashed(keys)
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], schema=_HASHES)

    return docs.select(text_col).mapInArrow(run, "h1 long, h2 long")


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys (rows of two integers): levels of bit arrays; a key belongs to the first level
    where it is alone at its position, and its index is the number of bits set before it."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.base = np.concatenate([[0], np.cumsum([(s + 63) // 64 for s in sizes])]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(bits))]).astype(np.int64)

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            return (mix64(keys[:, 0] ^ mix64(keys[:, 1] + seed)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, parts = np.asarray(keys).astype(np.uint64), [], []
        while len(left):
            size = max(64, int(1.5 * len(left)))
            at = cls._at(left, len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros((size + 63) // 64, dtype=np.uint64)
            np.bitwise_or.at(bits, at[alone] >> 6, np.uint64(1) << (at[alone] & 63).astype(np.uint64))
            sizes.append(size)
            parts.append(bits)
            left = left[~alone]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, np.uint64))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; of keys it was not built from any index, or -1."""
        out, todo = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        keys = keys.astype(np.uint64)
        for level, size in enumerate(self.sizes):
            at = self._at(keys[todo], level, size)
            word, bit = self.base[level] + (at >> 6), (at & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            w, b = word[hit], bit[hit]
            below = np.bitwise_count(self.bits[w] & ((np.uint64(1) << b) - np.uint64(1)))
            out[todo[hit]] = self.rank[w] + below
            todo = todo[~hit]
        return out


def build_shards(lines: DataFrame, n_shards: int) -> DataFrame:
    """lines (h1, h2, n), distinct by (h1, h2) -> one row per shard: shard, sizes, bits, prints, counts."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf[["h1", "h2"]].to_numpy()
        mph = PerfectHash.build(keys)
        at = mph.index(keys)
        prints, counts = np.empty(len(pdf), "<i8"), np.empty(len(pdf), "<u4")
        prints[at], counts[at] = pdf.h2, np.minimum(pdf.n, 0xFFFFFFFF)
        row = (int(pdf.shard.iloc[0]), np.array(mph.sizes, "<i8").tobytes(), mph.bits.tobytes(), prints.tobytes(), counts.tobytes())
        return pd.DataFrame([row], columns=["shard", "sizes", "bits", "prints", "counts"])

    keyed = lines.withColumn("shard", F.pmod("h1", F.lit(n_shards)).cast("int"))
    return keyed.groupBy("shard").applyInPandas(build, "shard int, sizes binary, bits binary, prints binary, counts binary")


class Shards:
    """The arrays of some shards, probed by the hashes of lines."""

    def __init__(self, n_shards: int, rows: list[tuple]):
        self.n_shards, self.rows = n_shards, rows
        self.at: dict[int, tuple] | None = None

    def counts(self, h: np.ndarray) -> np.ndarray:
        """The document count of each hash, 0 if it is in none of these shards."""
        if self.at is None:
            self.at = {
                s: (PerfectHash(np.frombuffer(z, "<i8").tolist(), np.frombuffer(b, "<u8")), np.frombuffer(p, "<i8"), np.frombuffer(c, "<u4"))
                for s, z, b, p, c in self.rows
            }
        out = np.zeros(len(h), dtype=np.int64)
        shard = h[:, 0] % self.n_shards
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.n_shards + 1)) if len(h) else np.zeros(self.n_shards + 1, int)
        for s, (mph, prints, counts) in self.at.items():
            own = order[edges[s] : edges[s + 1]]
            if len(own):
                i = mph.index(h[own])
                ok = i >= 0
                ok[ok] = prints[i[ok]] == h[own[ok], 1]
                out[own[ok]] = counts[i[ok]]
        return out


def _groups(shards: DataFrame, group_bytes: int) -> list[list[int]]:
    """Shards in groups of at most group_bytes (or one)."""
    size = sum((F.length(c) for c in ("bits", "prints", "counts")), F.lit(0))
    groups, room = [], 0
    for shard, n in shards.select("shard", size).orderBy("shard").collect():
        if not groups or room < n:
            groups.append([])
            room = group_bytes
        groups[-1].append(shard)
        room -= n
    return groups


def dedup_lines(
    docs: DataFrame, *, min_docs: int = MIN_DOCS, text_col: str = "text", shard_keys: int = SHARD_KEYS, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """docs with the lines left out whose key is in at least min_docs documents, and n_lines, n_dropped (long)."""
    sc, own = docs.sparkSession.sparkContext, [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    frequent = stored(line_hashes(docs, text_col).groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs))
    n_shards = max(1, -(-frequent.count() // shard_keys))
    shards = stored(build_shards(frequent, n_shards))
    held = [sc.broadcast([tuple(r) for r in shards.where(F.col("shard").isin(group)).collect()]) for group in _groups(shards, group_bytes) or [[]]]
    base = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c == text_col else F.col(c) for c in own])
    if len(held) == 1:
        return _cut(base, text_col, n_shards, held[0])
    key, drop = fresh("_key", own), fresh("_drop", own)
    hashes = stored(_text_hashes(base.select(F.md5(text_col).alias("key"), text_col)))
    marks = [_marks(hashes, n_shards, group) for group in held]
    for more in marks[1:]:
        marks[0] = marks[0].unionByName(more)
    by = marks[0].groupBy("key").agg(F.collect_set("marks").alias(drop)).withColumnRenamed("key", key)
    return _cut(base.withColumn(key, F.md5(text_col)).join(by, key, "left").select(*base.columns, drop), text_col, n_shards, marks_col=drop)


def _text_hashes(texts: DataFrame) -> DataFrame:
    """(key, text) -> key, hashes: of all lines in order, 16 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            hashes = [_hashed(line_keys(t)).tobytes() for t in binaries(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary())], ["key", "hashes"])

    return texts.mapInArrow(run, "key string, hashes binary")


_EMPTY = np.frombuffer(xxhash.xxh3_128_digest(b""), "<i8")


def _found(h: np.ndarray, shards: Shards) -> np.ndarray:
    """Which lines are in the shards; an empty key is in none."""
    return (shards.counts(h) > 0) & (h != _EMPTY).any(axis=1)


def _marks(hashes: DataFrame, n_shards: int, held) -> DataFrame:
    """(key, marks): one bit a line, of the texts with a line in the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(n_shards, held.value)
        for batch in sliced(batches):
            each = [np.frombuffer(x, "<i8").reshape(-1, 2) for x in batch.column(1).to_pylist()]
            mark = np.split(_found(np.concatenate(each), shards), np.cumsum([len(x) for x in each])[:-1])
            some = [i for i, m in enumerate(mark) if m.any()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some, pa.int64())), pa.array([np.packbits(mark[i]).tobytes() for i in some], pa.binary())], ["key", "marks"])

    return hashes.mapInArrow(run, "key string, marks binary")


def _cut(base: DataFrame, text_col: str, n_shards: int, held=None, *, marks_col: str | None = None) -> DataFrame:
    """base without the lines that are in the shards or marked, with n_lines and n_dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(n_shards, held.value) if held else None
        for batch in sliced(batches):
            texts = binaries(batch.column(text_col))
            lines = [t.split(b"\n") for t in texts]
            if shards:
                flat = _found(_hashed(k for t in texts for k in line_keys(t)), shards)
                marks = np.split(flat, np.cumsum([len(x) for x in lines])[:-1])
            else:
                bits = lambda own, n: np.unpackbits(np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in own]), count=n).astype(bool) if own else np.zeros(n, bool)
                marks = [bits(own, len(x)) for own, x in zip(batch.column(marks_col).to_pylist(), lines, strict=True)]
            kept = [b"\n".join([x for x, m in zip(own, mark, strict=True) if not m]) if mark.any() else text for text, own, mark in zip(texts, lines, marks, strict=True)]
            columns = {c: batch.column(c) for c in batch.schema.names if c != marks_col} | {text_col: pa.array(kept, pa.binary()).cast(pa.string())}
            columns |= {"n_lines": pa.array([len(x) for x in lines], pa.int64()), "n_dropped": pa.array([int(m.sum()) for m in marks], pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return base.mapInArrow(run, extended(base.drop(marks_col).schema if marks_col else base.schema, n_lines="long", n_dropped="long"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH l AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
     e AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM l),
     k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
     f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY r, doc_id
"""
