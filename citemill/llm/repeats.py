"""Removal of long byte strings that occur more than once, with enhanced suffix arrays.

Every window of `length` bytes is assigned to its minimizer, the least hash among its GRAM-byte grams; equal windows have equal
minimizers. Consecutive windows with one minimizer make a segment, so that suffixes which may share `length` bytes meet by the
minimizer's hash. Segments travel as hashes; only one copy of each distinct segment, of minimizers that distinct segments share,
is shuffled as text. Groups of segments are put into blocks, and a block into a suffix array with the lengths of common
prefixes; a stack scan walks its tree of common-prefix intervals and reports those with different bytes to the left: the
maximal repeats, with all their occurrences.

A minimizer with over HOT_SEGMENTS distinct segments (the edge of a passage that many documents share) is too large for a block.
Its windows are told apart by how many bytes they have before the minimizer: equal windows have as many. The range of these numbers
is halved, and so each segment in two; windows of one half share more than the minimizer, and are grouped by all that they share.
Parts that are alone in their group are done, equal ones are repeats as a whole, groups that are small enough go to the suffix
arrays, and the rest is halved again, at most eight times: a range of one holds equal windows alone.

Defined results: a null text is empty; texts shorter than `length` bytes stay; rows that repeat count as further occurrences;
strings never reach from one document into another; an empty table gives no rows; further columns pass through, whatever their
names, but for those named as the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import binaries, bitmap, doc_keys, extended, fresh, in_bitmap, mix64, powers, prefix_hashes, stored, table

LENGTH = 200
GRAM = 32
#: Windows of a text that are looked at together.
CHUNK = 1 << 20
#: So many segments of at most 2 * LENGTH bytes fill a block of a few MB.
HOT_SEGMENTS = 1024
BLOCK_BYTES = 1 << 20


def segments(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each chunk of a text: the first window, the end of the last window, and the minimizer's hash of its segments."""
    for at in range(0, max(0, len(text) - length + 1), CHUNK):
        b = np.frombuffer(text, np.uint8, count=min(CHUNK + length - 1, len(text) - at), offset=at)
        n, inverse = len(b), powers(len(b) + 1)[1]
        s = prefix_hashes(b)
        h = mix64((s[gram:] - s[:-gram]) * inverse[: n - gram + 1])
        # Hash above, position below: the least one is the leftmost gram of the least hash.
        best = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
        width, span = 1, length - gram + 1
        while 2 * width <= span:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if width < span:
            best = np.minimum(best[: len(best) - (span - width)], best[span - width :])
        where = (best & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(where)) + 1])
        last = np.append(first[1:], len(where))
        yield first + at, last + at + length - 1, h[where[first]].astype(np.int64)


def maximal_repeats(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, np.ndarray]]:
    """The maximal repeats of at least `length` bytes within and among texts: length, and all places in the joined texts.

    A text's first byte has no byte to its left, which counts as different from any other.
    """
    joined = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    b, n = np.frombuffer(joined, np.uint8), len(joined)
    if n < length:
        return
    end = np.repeat(ends, [len(t) for t in texts])
    s, inverse = prefix_hashes(b), powers(n + 1)[1]
    starts = np.flatnonzero(np.arange(n) + length <= end)
    window = (s[starts + length] - s[starts]) * inverse[starts]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    candidates = np.sort(starts[order[twice]])
    if not len(candidates):
        return
    stop = end[candidates].tolist()
    suffixes = [joined[p:q] for p, q in zip(candidates.tolist(), stop, strict=True)]
    sa = candidates[sorted(range(len(suffixes)), key=suffixes.__getitem__)]
    del suffixes
    # Lengths of common prefixes of neighbours, by binary search over hashes.
    p, q = sa[:-1], sa[1:]
    lo, hi = np.zeros(len(p), np.int64), np.minimum(end[p] - p, end[q] - q)
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        eq = (s[p + mid] - s[p]) * inverse[p] == (s[q + mid] - s[q]) * inverse[q]
        lo, hi = np.where(eq, mid, lo), np.where(eq, hi, mid - 1)
    begins = np.zeros(n, bool)
    begins[np.concatenate([[0], ends[:-1]])[[len(t) > 0 for t in texts]]] = True
    left = np.where(begins[sa], -1, b[sa - 1].astype(np.int64)).tolist()  # -1: different bytes
    stack: list[list[int]] = []  # depth, first index, byte to the left
    for i, depth in enumerate([*lo.tolist(), -1]):
        first, byte = i, left[i]
        while stack and stack[-1][0] > depth:
            d, first, own = stack.pop()
            byte = byte if own == byte else -1
            if byte < 0:
                yield d, sa[first : i + 1]
        if depth >= length:
            if stack and stack[-1][0] == depth:
                stack[-1][2] = byte if stack[-1][2] == byte else -1
            else:
                stack.append([depth, first, byte])


def covered(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Of each text, the [start, end) rows of what its repeats cover."""
    n = sum(map(len, texts))
    edge = np.zeros(n + 1, np.int64)
    for depth, places in maximal_repeats(texts, length):
        np.add.at(edge, places, 1)
        np.add.at(edge, places + depth, -1)
    inside, out, at = np.cumsum(edge[:-1]) > 0, [], 0
    for t in texts:
        out.append(runs(inside[at : at + len(t)]))
        at += len(t)
    return out


def runs(inside: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(np.concatenate([[0], inside, [0]]).astype(np.int8))).reshape(-1, 2)


def _each(docs: DataFrame, emit, schema: str) -> DataFrame:
    """emit(text, r1, r2, chunk) -> lists of values for each chunk of each text; keyed docs (text, r1, r2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(_parse_schema(schema))
        for batch in batches:
            columns: list[list] = [[] for _ in arrow]
            size = 0
            for text, r1, r2 in zip(binaries(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for chunk in segments(text):
                    got = emit(text, r1, r2, *chunk)
                    if got is not None:
                        for c, v in zip(columns, got, strict=True):
                            c.append(v)
                        size += len(got[0])
                if size > 50_000:
                    yield _joined(columns, arrow)
                    columns, size = [[] for _ in arrow], 0
            if size:
                yield _joined(columns, arrow)

    return docs.mapInArrow(run, schema)


def _joined(columns: list[list], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(sum(c, []), f.type) if isinstance(c[0], list) else pa.array(np.concatenate(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def _parse_schema(schema: str):
    from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

    kinds = {"long": LongType(), "int": IntegerType(), "binary": BinaryType()}
    return StructType([StructField(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])


def _hash128(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), "<i8").reshape(-1, 2)


def _places(r1: int, r2: int, first: np.ndarray) -> np.ndarray:
    """A hash of where a segment stands."""
    seed = np.uint64((r1 ^ (r2 * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF)
    return mix64(first.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) ^ seed).astype(np.int64)


def repeated_spans(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(r1, r2, spans): of each document with some repeated string, an array of (int32 start, end) pairs, not merged."""
    sc = docs.sparkSession.sparkContext
    keyed = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), *doc_keys(doc_id, text_col))

    # 1. Minimizers of two or more segments, as a bitmap of fixed size.
    minimizers = _each(keyed, lambda text, r1, r2, first, last, h: (h,), "h long")
    bits = sc.broadcast(bitmap(minimizers.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "h"))

    # 2. Where segments with these minimizers stand, with hashes of their texts.
    def occurrences(text, r1, r2, first, last, h):
        own = in_bitmap(np.frombuffer(bits.value, np.int64), h)
        if not own.any():
            return None
        first, last, h = first[own], last[own], h[own]
        k = _hash128([text[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)])
        same = np.ones(len(h), np.int64)
        return h, k[:, 0], k[:, 1], same * r1, same * r2, first.astype(np.int32), (last - first).astype(np.int32), _places(r1, r2, first)

    occ = stored(_each(keyed, occurrences, "h long, k1 long, k2 long, r1 long, r2 long, start int, n int, place long"))

    # 3. Distinct segments; how many of them share a minimizer.
    distinct = stored(occ.groupBy("h", "k1", "k2").agg(F.count("*").alias("times"), F.min("place").alias("place"), F.first("n").alias("n")))
    shared = stored(distinct.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    whole = distinct.where("times > 1").select("k1", "k2", F.lit(0).alias("lo"), F.col("n").alias("hi"))
    several = stored(distinct.join(shared, "h").select("place", "kinds"))

    # 4. One copy of each distinct segment, to the suffix arrays or to be halved.
    def copies(held):
        def emit(text, r1, r2, first, last, h):
            own = in_bitmap(np.frombuffer(bits.value, np.int64), h)
            own[own] = in_bitmap(np.frombuffer(held.value, np.int64), _places(r1, r2, first[own]))
            if not own.any():
                return None
            return h[own], [text[a:b] for a, b in zip(first[own].tolist(), last[own].tolist(), strict=True)]

        return emit

    wanted = sc.broadcast(bitmap(several.where(f"kinds <= {HOT_SEGMENTS}"), "place"))
    covers = whole.unionByName(_in_blocks(_each(keyed, copies(wanted), "h long, segment binary"), "h"))
    hot = several.where(f"kinds > {HOT_SEGMENTS}")
    if not hot.isEmpty():
        held = sc.broadcast(bitmap(hot, "place"))
        own = _each(keyed, copies(held), "h long, segment binary").join(shared.where(f"kinds > {HOT_SEGMENTS}").select("h"), "h", "left_semi")
        covers = covers.unionByName(_halved(stored(own.select("segment").distinct())))

    pair = F.concat(_int32(F.expr("start + lo")), _int32(F.expr("start + hi")))
    return occ.join(covers, ["k1", "k2"]).groupBy("r1", "r2").agg(F.collect_list(pair).alias("spans"))


def _in_blocks(texts: DataFrame, *key: str) -> DataFrame:
    """texts (key, segment) -> (k1, k2, lo, hi): what repeats cover of each distinct segment, by its hash."""
    parts = texts.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return texts.select(*key, "segment").repartition(int(parts), *key).sortWithinPartitions(*key).mapInArrow(_suffix_arrays, "k1 long, k2 long, lo int, hi int")


def _anchor(segment: bytes) -> int:
    """Where the minimizer stands in a segment."""
    b = np.frombuffer(segment, np.uint8)
    s, n = prefix_hashes(b), len(b)
    h = mix64((s[GRAM:] - s[:-GRAM]) * powers(n + 1)[1][: n - GRAM + 1])
    return int(np.argmin(h & ~np.uint64((1 << 24) - 1)))


def halves(segment: bytes, lo: int, hi: int, length: int = LENGTH) -> Iterator[tuple[bytes, int, bytes, int, int]]:
    """Of the windows of a segment that have lo to hi - 1 bytes before the minimizer, in halves: what all such windows share, where
    the part with the segment's own ones begins, the part, and the range."""
    at = _anchor(segment)
    mid = (lo + hi) // 2
    for a, b in ((lo, mid), (mid, hi)):
        least, most = max(a, at - (len(segment) - length)), min(b - 1, at)
        if least <= most:
            yield segment[at - a : at + length + 1 - b], at - most, segment[at - most : at - least + length], a, b


def _halved(segments_: DataFrame) -> DataFrame:
    """(segment), distinct ones of hot minimizers -> (k1, k2, lo, hi): what repeats cover of each, by its hash."""
    names = ["g1", "g2", "t1", "t2", "k1", "k2", "off", "n", "a", "b"]
    schema = "g1 long, g2 long, t1 long, t2 long, k1 long, k2 long, off int, n int, a int, b int, segment binary"
    arrow = to_arrow_schema(_parse_schema(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for segment, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("segment", "a", "b")), strict=True):
                rows += [(core, off, part, a, b, segment) for core, off, part, a, b in halves(segment, lo, hi)]
            if not rows:
                continue
            g = _hash128([b"%d %d " % (a, b) + core for core, _, _, a, b, _ in rows])
            t, k = _hash128([r[2] for r in rows]), _hash128([r[5] for r in rows])
            values = [g[:, 0], g[:, 1], t[:, 0], t[:, 1], k[:, 0], k[:, 1], [r[1] for r in rows], [len(r[2]) for r in rows], [r[3] for r in rows], [r[4] for r in rows]]
            columns = [pa.array(np.array(v), arrow.field(c).type) for c, v in zip(names, values, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([r[5] for r in rows], pa.binary())], schema=arrow)

    open_ = segments_.select("segment", F.lit(0).alias("a"), F.lit(LENGTH - GRAM + 1).alias("b"))
    out: list[DataFrame] = []
    while not open_.isEmpty():
        parts = stored(open_.mapInArrow(run, schema))
        text = F.expr("substring(segment, off + 1, n)").alias("segment")
        kinds = stored(parts.groupBy("g1", "g2", "t1", "t2").agg(F.count("*").alias("times"), F.first(text).alias("segment")))
        size = stored(kinds.groupBy("g1", "g2").agg(F.count("*").alias("size")).where("size > 1"))
        twice = kinds.where("times > 1").select("g1", "g2", "t1", "t2")
        out.append(parts.join(twice, ["g1", "g2", "t1", "t2"], "left_semi").selectExpr("k1", "k2", "off AS lo", "off + n AS hi"))
        few = kinds.join(size.where(f"size <= {HOT_SEGMENTS}"), ["g1", "g2"], "left_semi")
        found = _in_blocks(few, "g1", "g2").withColumnsRenamed({"k1": "t1", "k2": "t2"})
        out.append(parts.join(found, ["t1", "t2"]).selectExpr("k1", "k2", "off + lo AS lo", "off + hi AS hi"))
        open_ = parts.join(size.where(f"size > {HOT_SEGMENTS}"), ["g1", "g2"], "left_semi").select("segment", "a", "b")
    covers = out[0]
    for df in out[1:]:
        covers = covers.unionByName(df)
    return stored(covers.distinct())


def _int32(column):
    """Four bytes, big-endian."""
    return F.unhex(F.lpad(F.hex(column), 8, "0"))


def _suffix_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, segment), sorted by the key, in blocks of whole groups."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

    def solved(block: list[bytes]) -> pa.RecordBatch:
        keep = [(t, c) for t, c in zip(block, covered(block), strict=True) if len(c)]
        k = np.repeat(_hash128([t for t, _ in keep]), [len(c) for _, c in keep], axis=0)
        spans = np.concatenate([c for _, c in keep]) if keep else np.zeros((0, 2), np.int64)
        columns = [pa.array(x.copy(), t) for x, t in zip((k[:, 0], k[:, 1], spans[:, 0], spans[:, 1]), schema.types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    block: list[bytes] = []
    group: dict[bytes, None] = {}
    last, size = None, 0
    for batch in batches:
        for *key, segment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != last:
                if len(group) > 1:
                    block.extend(group)
                    size += sum(map(len, group))
                group, last = {}, key
                if size > BLOCK_BYTES:
                    yield solved(block)
                    block, size = [], 0
            group[segment] = None
    if len(group) > 1:
        block.extend(group)
    if block:
        yield solved(block)


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text as binary (a cut may split a code point), and n_bytes, n_removed, n_spans (long)."""
    own = [c for c in docs.columns if c.lower() not in ("n_bytes", "n_removed", "n_spans")]
    docs = docs.select(*own)
    r1, r2, spans_col = (fresh(c, own) for c in ("r1", "r2", "spans"))
    spans = repeated_spans(docs, doc_id=doc_id, text_col=text_col).toDF(r1, r2, spans_col)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    keys = [k.alias(c) for k, c in zip(doc_keys(doc_id, text_col), (r1, r2), strict=True)]
    joined = docs.select(*[text.alias(c) if c == text_col else F.col(c) for c in own], *keys).join(spans, [r1, r2], "left").select(*own, spans_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            for text, spans in zip(batch.column(text_col).to_pylist(), batch.column(spans_col).to_pylist(), strict=True):
                n_bytes.append(len(text))
                if spans:
                    pairs = np.frombuffer(b"".join(spans), ">i4").reshape(-1, 2)
                    edge = np.bincount(pairs[:, 0], minlength=len(text) + 1) - np.bincount(pairs[:, 1], minlength=len(text) + 1)
                    inside = np.cumsum(edge[:-1]) > 0
                    cut = runs(inside)
                    n_removed.append(int(inside.sum()))
                    n_spans.append(len(cut))
                    text = np.frombuffer(text, np.uint8)[~inside].tobytes()
                else:
                    n_removed.append(0)
                    n_spans.append(0)
                kept.append(text)
            columns = {c: batch.column(c) for c in batch.schema.names if c != spans_col} | {text_col: pa.array(kept, pa.binary())}
            columns |= {"n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return joined.mapInArrow(run, extended(joined.drop(spans_col).schema, n_bytes="long", n_removed="long", n_spans="long"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))
