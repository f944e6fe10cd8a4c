"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes cuts a text into pieces wherever it hits the block size's residue; each piece gives
one character of a signature. A fingerprint is `block:signature:signature:signature`, of the block size, twice and four times
that. Two fingerprints are compared by weighted edit distance (a replacement is a deletion and an insertion) of signatures of
equal block size, where they share a run of RUN characters (short ones: of a third of the shorter).

Defined results: a null text is empty; its fingerprint is `3:::`; equal fingerprints have likeness 1; without a block size in
common it is 0. Documents follow each other in ascending order of doc_id, null first; those of one id in that of a hash of their
texts; rows that repeat follow each other, and a document alone follows itself. An empty table gives no rows; further columns pass
through fingerprints(), but for one of that name, which is replaced.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binaries, extended, mix64, powers, prefix_hashes, sliced, table

LEAST_BLOCK = 3
LENGTH = 64
RUN = 4
#: Bytes of text in a range of documents that follow each other.
RANGE_BYTES = 16 << 20
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _rolling(b: np.ndarray) -> np.ndarray:
    """At each byte, a 32-bit hash of the seven bytes that end there."""
    padded = np.concatenate([np.zeros(6, np.uint32), b.astype(np.uint32)])
    h = np.zeros(len(b), np.uint32)
    for k in range(7):
        c = padded[k : k + len(b)]
        h += c * np.uint32(k + 2)
        h ^= c << np.uint32(5 * (6 - k) % 32)
    h *= np.uint32(0x9E3779B1)
    return h ^ (h >> np.uint32(15))


def _signature(b: np.ndarray, sums: np.ndarray, h: np.ndarray, block: int) -> bytes:
    cuts = np.flatnonzero(h % np.uint32(block) == block - 1)[: LENGTH - 1] + 1
    edges = np.unique(np.concatenate([[0], cuts, [len(b)]]))
    lo, hi = edges[:-1], edges[1:]
    piece = mix64((sums[hi] - sums[lo]) * powers(len(b) + 1)[1][lo])
    return ALPHABET[(piece >> np.uint64(40)).astype(np.int64) & 63].tobytes()


def fingerprint(text: bytes) -> str:
    b = np.frombuffer(text, np.uint8)
    if not len(b):
        return f"{LEAST_BLOCK}:::"
    sums = prefix_hashes(b)
    h = _rolling(b)
    block = LEAST_BLOCK
    while block * LENGTH < len(b):
        block *= 2
    while True:
        one = _signature(b, sums, h, block)
        if block == LEAST_BLOCK or len(one) >= LENGTH // 2:
            return ":".join([str(block), one.decode(), *(_signature(b, sums, h, k * block).decode() for k in (2, 4))])
        block //= 2


def edit_likeness(a: str, b: str) -> float:
    """1 - the weighted edit distance over both lengths; 0 without a common run of RUN characters, or fewer for short ones."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    n = min(RUN, max(1, min(len(a), len(b)) // 3))
    runs = {a[i : i + n] for i in range(len(a) - n + 1)}
    if not any(b[i : i + n] in runs for i in range(len(b) - n + 1)):
        return 0.0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    s = full = (1 << len(a)) - 1
    for c in b:  # common subsequence, one bit for each character of a
        u = s & places.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return 2 * (len(a) - s.bit_count()) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """Of two fingerprints, 0 to 1."""
    if x == y:
        return 1.0
    (bx, *xs), (by, *ys) = x.split(":"), y.split(":")
    left = {int(bx) << k: v for k, v in enumerate(xs)}
    return max((edit_likeness(left[b], v) for k, v in enumerate(ys) if (b := int(by) << k) in left), default=0.0)


def edited(text: str, following: str) -> str:
    """text, the last half of it replaced by as many of the first characters of the following one, or by all it has."""
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """docs with a fingerprint (string)."""
    docs = docs.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            prints = [fingerprint((t or "").encode()) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints)], [*batch.schema.names, "fingerprint"])

    return docs.mapInArrow(run, extended(docs.schema, fingerprint="string"))


def with_next(docs: DataFrame, body, schema: str, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Deal (doc_id, text) in ascending order of doc_id (null first; equal ids by a hash of the text) into contiguous ranges, each
    with the first row that follows it, and run body over (id, text, next text); the first document follows the last.

    A first pass over ids, hashes and sizes, sorted by ranges, cuts a range after every range_bytes of text; the first key of each
    range (24 bytes) comes to the driver and goes to all tasks. Texts are moved once.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keys = own.select(F.col("doc_id").isNotNull().alias("known"), "doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = -1
        for batch in batches:
            firsts = []
            for i, size in enumerate(batch.column("size").to_pylist()):
                if room < 0:
                    firsts.append(i)
                    room = range_bytes
                room -= size
            yield batch.select(["known", "doc_id", "h"]).take(pa.array(firsts, pa.int64()))

    order = ["known", "doc_id", "h"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(cut, "known boolean, doc_id long, h long").collect()
    bounds = sorted({(r.known, r.doc_id or 0, r.h) for r in found})
    held = spark.sparkContext.broadcast(bounds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = held.value
        for batch in sliced(batches):
            rows, part, extra, hashes = [], [], [], []
            for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), binaries(batch.column("text")), strict=True)):
                h = xxhash.xxh64_intdigest(text, seed=42)
                h -= (h >> 63) << 64
                key = (doc_id is not None, doc_id or 0, h)
                k = bisect_right(cuts, key) - 1
                # The first row of a range also ends the range before it, and the first of all the last range.
                for p, e in ((k, 0), ((k - 1) % len(cuts), 1)) if cuts[k] == key else ((k, 0),):
                    rows.append(i)
                    part.append(p)
                    extra.append(e)
                    hashes.append(h)
            columns = [*batch.take(pa.array(rows, pa.int64())).columns, pa.array(part, pa.int32()), pa.array(extra, pa.int32()), pa.array(hashes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "part", "extra", "h"])

    dealt = own.mapInArrow(deal, "doc_id long, text string, part int, extra int, h long").repartitionById(max(1, len(bounds)), "part")
    dealt = dealt.sortWithinPartitions("part", "extra", F.col("doc_id").asc_nulls_first(), "h").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in sliced(batches):
                yield from zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "extra")), strict=True)

        yield from body(_pairs(rows()))

    return dealt.mapInArrow(run, schema)


def _pairs(rows):
    """(id, text, next text) of each row that isn't extra; extra ones only follow the last row of their range."""
    held = None
    for doc_id, text, part, extra in rows:
        if held is not None and held[2] == part:
            yield held[0], held[1], text
            held = None
        if not extra:
            held = (doc_id, text, part)


def op3_fuzzy_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()], strict=True)))

    def body(pairs) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        known: tuple[str, str] | None = None
        for doc_id, text, following in pairs:
            changed = edited(text, following).encode()
            own = known[1] if known and known[0] is text else fingerprint(text.encode())
            after, then = fingerprint(changed), fingerprint(following.encode())
            known = (following, then)
            out.append((doc_id, len(text), hashlib.sha256(changed).hexdigest(), own, after, likeness(own, after), likeness(own, then)))
            if len(out) == 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_next(docs, body, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
