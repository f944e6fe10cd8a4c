"""Near-duplicate classes with Order MinHash.

A document's k-mers are its five-word shingles, each labelled with its occurrence number. For each of SKETCHES seeds the PICK
k-mers with the least hashes, in the order of the text, are hashed to a key. Documents that share a key are candidates. A candidate
pair is verified by a banded alignment of its k-mers: the longest chain of matches in the same order in both, over all k-mers of
the two that are not matched twice (matches / (both lengths - matches)); two documents are alike if that is THRESHOLD or more.
The band is as wide as a pair at the threshold can move, so that it leaves no chain out. This is an edit similarity: parts that are
moved or repeated count as edits. Classes are the connected components of alike pairs.

Exact copies (the same words) are one node from the start. In a bucket of a key, members are first compared with its hubs (its
first and its last member in one of four orders). Members of buckets that are then still in several classes are the crowd: texts
with a common passage, say, that are not alike. All alike pairs of the crowd are found by a prefix filter, which is exact: with
the k-mers of each member ordered from rare to frequent, two alike members share one of their first n - ceil(THRESHOLD * n) + 1.
Groups that share such a k-mer are compared in blocks, where signatures rule out pairs that cannot be alike, and never others.

Nodes are 128-bit hashes of a document's words.

Defined results: documents without words are alike only if their texts are equal (null is empty); texts of fewer than five words
are one shingle; a class is named by its least doc_id (null only if it has no other); rows that repeat are in one class; an empty
table gives no rows; further columns pass through keep_one(), whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binaries, bitmap, components, extended, freed, fresh, in_bitmap, mix64, powers, prefix_hashes, sliced, stored, table, words_of

K = 5
THRESHOLD = 0.8
SKETCHES = 16
PICK = 3
_SEEDS = mix64(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_P = np.uint64(0xD6E8FEB86659FD93)
#: Bits of a signature; members of a group in a block of pairs; slots of the k-mer counts that order prefixes.
SIGNATURE = 1024
BLOCK = 1024
SLOTS = 1 << 21


def word_hashes(words: list[bytes]) -> np.ndarray:
    """32 bits of each word."""
    if not words:
        return np.zeros(0, np.uint32)
    b = np.frombuffer(b" ".join(words), np.uint8)
    space = np.flatnonzero(b == 32)
    lo, hi = np.concatenate([[0], space + 1]), np.append(space, len(b))
    s = prefix_hashes(b)
    return (mix64((s[hi] - s[lo]) * powers(len(b) + 1)[1][lo]) >> np.uint64(32)).astype(np.uint32)


def labelled(words: np.ndarray, k: int = K) -> np.ndarray:
    """The hashes of the shingles, labelled by occurrence, in the order of the text."""
    w = words.astype(np.uint64)
    if not len(w):
        return w
    h = np.zeros(max(1, len(w) - k + 1), np.uint64)
    for j in range(min(k, len(w))):
        h = h * _P + w[j : j + len(h)]
    h = mix64(h)
    order = np.argsort(h, kind="stable")
    same = np.concatenate([[False], h[order][1:] == h[order][:-1]])
    n = np.arange(len(h))
    occurrence = np.empty(len(h), np.int64)
    occurrence[order] = n - np.maximum.accumulate(np.where(same, 0, n))
    return mix64(h + occurrence.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def order_minhash(labels: np.ndarray) -> np.ndarray:
    """SKETCHES keys, as int64: of each seed the PICK labels of the least hashes, in the order of the text."""
    n = len(labels)
    if n > PICK:  # one seed at a time, so that a very long text takes no more than a few copies of its labels
        pick = np.array([labels[np.sort(np.argpartition(mix64(labels ^ seed), PICK - 1)[:PICK])] for seed in _SEEDS])
    else:
        pick = np.tile(labels, (SKETCHES, 1))
    key = _SEEDS.copy()
    for j in range(pick.shape[1]):
        key = mix64(key * _P + pick[:, j])
    return key.astype(np.int64)


def signature(labels: np.ndarray) -> bytes:
    """SIGNATURE bits, each the parity of the labels that fall on it: two sets differ in as many labels as bits, at least."""
    count = np.bincount((labels % np.uint64(SIGNATURE)).astype(np.int64), minlength=SIGNATURE)
    return np.packbits(count.astype(np.uint8) & 1).tobytes()


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Of two labelled sequences, by the longest chain of matches in order within the band; 0 where a bound shows that it is
    below the threshold."""
    if not len(a) or not len(b):
        return 0.0
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(common) / (len(a) + len(b) - len(common)) < threshold:
        return 0.0
    band = int((len(a) + len(b)) * (1 - threshold) / (1 + threshold)) + 1
    order = np.argsort(ia)
    at, to = ia[order], ib[order]
    to = to[np.abs(at - to) <= band]
    n = len(to)
    if n > 1 and (np.diff(to) < 0).any():
        tails: list[int] = []
        for x in to.tolist():
            i = bisect_left(tails, x)
            if i == len(tails):
                tails.append(x)
            else:
                tails[i] = x
        n = len(tails)
    return n / (len(a) + len(b) - n)


def alike(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Whether two documents, as hashes of words, are near copies."""
    return similarity(labelled(x), labelled(y), threshold) >= threshold


def _node(text: bytes, words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else xxhash.xxh3_128_digest(text, seed=1)


def nodes_of(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, node (16 bytes), n (k-mers), keys (array of long; none without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            node, n, keys = [], [], []
            for text in binaries(batch.column(1)):
                words = words_of(text)
                labels = labelled(word_hashes(words))
                node.append(_node(text or b"", words))
                n.append(len(labels))
                keys.append(order_minhash(labels) if len(labels) else [])
            columns = [pa.array(node, pa.binary()), pa.array(n, pa.int32()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "node", "n", "keys"])

    return docs.select(F.col(doc_id).alias("doc_id"), text_col).mapInArrow(run, extended(docs.select(F.col(doc_id).alias("doc_id")).schema, node="binary", n="int", keys="array<long>"))


def with_node(docs: DataFrame, text_col: str = "text", name: str = "node") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            node = pa.array([_node(t or b"", words_of(t)) for t in binaries(batch.column(text_col))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, node], [*batch.schema.names, name])

    return docs.mapInArrow(run, extended(docs.schema, **{name: "binary"}))


def words_of_nodes(docs: DataFrame, nodes: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(node, words): the words' hashes of some nodes (and perhaps of others), each once, as a stored table."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(nodes.select(F.xxhash64("node").alias("h")), "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits.value, np.int64)
        for batch in sliced(batches):
            words = [w for w in map(words_of, binaries(batch.column(0))) if w]
            own = [_node(b"", w) for w in words]
            h = np.array([xxhash.xxh64_intdigest(x, seed=42) for x in own], np.uint64).astype(np.int64)
            first = {own[i]: i for i in np.flatnonzero(in_bitmap(held, h)).tolist()}
            yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.binary()), pa.array([word_hashes(words[i]).tobytes() for i in first.values()], pa.binary())], ["node", "words"])

    out = stored(docs.select(text_col).mapInArrow(run, "node binary, words binary").groupBy("node").agg(F.first("words").alias("words")))
    bits.destroy()  # the table is written: nothing asks for the bitmap again
    return out


def verified(words: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) of nodes that are near copies; words as of words_of_nodes()."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            keep = [alike(np.frombuffer(p, np.uint32), np.frombuffer(q, np.uint32), threshold) for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("x")), "a").join(words.select(F.col("node").alias("b"), F.col("words").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(check, "a binary, b binary")


def prefixes(crowd: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """crowd (node, n, root, words) -> (node, n, root, sig, labels): the signature of each member, and the rarest
    n - ceil(threshold * n) + 1 of its k-mers, from rare to frequent, but for those that no other member has. Rare: by counts in
    SLOTS slots of hashes, a fixed order that all members share."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(SLOTS, np.int64)
        for batch in sliced(batches):
            for w in batch.column(0).to_pylist():
                np.add.at(count, (labelled(np.frombuffer(w, np.uint32)) % np.uint64(SLOTS)).astype(np.int64), 1)
        slot = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(count[slot])], ["slot", "c"])

    # At most SLOTS rows come to the driver, and go back as one array.
    got = crowd.select("words").mapInArrow(counted, "slot int, c long").groupBy("slot").agg(F.sum("c").alias("c")).toArrow()
    total = np.zeros(SLOTS, np.uint32)
    total[got.column("slot").to_numpy()] = np.minimum(got.column("c").to_numpy(), 0xFFFFFFFF)
    held = crowd.sparkSession.sparkContext.broadcast(total)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sig, kept = [], []
            for w in batch.column("words").to_pylist():
                labels = labelled(np.frombuffer(w, np.uint32))
                c = held.value[(labels % np.uint64(SLOTS)).astype(np.int64)]
                first = np.lexsort((labels, c))[: len(labels) - int(np.ceil(threshold * len(labels) - 1e-9)) + 1]
                kept.append(labels[first[c[first] > 1]].astype(np.int64))
                sig.append(signature(labels))
            own = [batch.column(c) for c in ("node", "n", "root")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sig, pa.binary()), pa.array(kept, pa.list_(pa.int64()))], ["node", "n", "root", "sig", "labels"])

    return crowd.select("words", "node", "n", "root").mapInArrow(rare, "node binary, n int, root binary, sig binary, labels array<long>")


def _group_pairs(group: pa.RecordBatch, threshold: float) -> list[tuple[bytes, bytes]]:
    """The pairs of nodes of one block (or of two, then across them) that are in two classes and not ruled out. Of the labels that
    two nodes share, only the rarest gives the pair."""
    node = group.column("node").to_pylist()
    own, n = group.column("own").to_numpy(), group.column("n").to_numpy()
    roots: dict[bytes, int] = {}
    root = np.array([roots.setdefault(r, len(roots)) for r in group.column("root").to_pylist()])
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint64).reshape(len(node), -1)
    across = group.column("bi")[0].as_py() != group.column("bj")[0].as_py()
    before = [frozenset(x) for x in group.column("rarer").to_pylist()]
    most = (1 - threshold) / (1 + threshold)
    out = []
    for i in range(len(node) - 1):
        rest = slice(i + 1, None)
        keep = root[rest] != root[i]
        if across:
            keep &= own[rest] != own[i]
        k = i + 1 + np.flatnonzero(keep)
        k = k[np.minimum(n[k], n[i]) >= threshold * np.maximum(n[k], n[i]) - 1e-6]
        k = k[np.bitwise_count(sig[k] ^ sig[i]).sum(axis=1) <= (n[k] + n[i]) * most + 1e-6]
        out += [(min(node[i], node[j]), max(node[i], node[j])) for j in k.tolist() if before[i].isdisjoint(before[j])]
    return out


def pairs_in_groups(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """rows (label, node, n, root, sig, rarer: its labels before this one) -> (a, b), each once: the pairs that share a label, are in two classes and not ruled out.

    The members of a group are dealt to blocks, and pairs of blocks to tasks: a group of any size is spread, and a member is
    copied once for each block of its group.
    """
    sizes = rows.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "label").withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("label", F.least("own", "with").alias("bi"), F.greatest("own", "with").alias("bj"), "own", "node", "n", "root", "sig", "rarer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(group: pa.RecordBatch) -> pa.RecordBatch:
            got = _group_pairs(group, threshold)
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in got], pa.binary()) for k in (0, 1)], ["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([*held, batch])
            ids = [rows.column(c).to_numpy() for c in ("label", "bi", "bj")]
            ends = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], axis=0)) + 1
            start = 0
            for end in ends.tolist():
                yield found(rows.slice(start, end - start))
                start = end
            held = [rows.slice(start)]
        for group in held:
            yield found(group)

    by = ["label", "bi", "bj"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a binary, b binary")


def connected(docs: DataFrame, nodes: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(node, root) of the nodes with verified links to other texts; the links are enough to connect every class."""
    node = nodes.groupBy("node").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    each = node.select("node", "n", F.explode("keys").alias("key"))
    # Four orders of nodes, by key, so that a class has several hubs.
    each = each.withColumn("o", F.xxhash64("node", F.pmod("key", F.lit(4))))
    member = F.struct("o", "node", "n")
    # Stored, so that the join is one of two plain exchanges, whose crowded keys Spark splits.
    hubs = stored(each.groupBy("key").agg(F.min(member).alias("first"), F.max(member).alias("last"), F.count("*").alias("size")).where("size > 1"))
    buckets = stored(each.drop("o").join(hubs, "key"))
    words = words_of_nodes(docs, buckets, text_col=text_col)

    def pairs(hub: str) -> DataFrame:
        own = buckets.select("node", "n", F.col(f"{hub}.node").alias("hub"), F.col(f"{hub}.n").alias("hn"))
        own = own.where((F.col("node") != F.col("hub")) & F.expr(f"least(n, hn) >= {threshold} * greatest(n, hn)"))
        return own.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))

    tested = stored(pairs("first").union(pairs("last")).distinct())
    found = stored(verified(words, tested, threshold))
    root = components(found)
    # The crowd: members of buckets in which the hubs left several classes (of three members, they met all).
    rooted = buckets.where("size > 3").select("key", "node", "n").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = stored(rooted.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("key"))
    crowd = stored(rooted.join(several, "key", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("root").alias("root")).join(words, "node"))
    freed(buckets, hubs, several)
    if crowd.isEmpty():
        freed(words, tested, found, crowd)
        return root
    members = stored(prefixes(crowd, threshold))
    rows = members.select(F.posexplode("labels").alias("at", "label"), "node", "root")
    open_ = rows.groupBy("label").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("label")
    # Labels of one class alone give no pair: they go before anything is joined to the rest.
    own = rows.drop("root").join(open_, "label", "left_semi").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("at", "label"))).alias("own"))
    own = own.select("node", F.col("own.label").alias("labels")).join(members.drop("labels"), "node")
    rows = own.select(F.posexplode("labels").alias("at", "label"), "*").select("label", "node", "n", "root", "sig", F.expr("slice(labels, 1, at)").alias("rarer"))
    left = pairs_in_groups(rows, threshold).join(tested, ["a", "b"], "left_anti")
    whole = components(found.union(verified(words, left, threshold)))
    freed(words, tested, found, crowd, members, root)
    return whole


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node, root, class_id, class_size (long): one row per document."""
    nodes = stored(nodes_of(docs, doc_id=doc_id, text_col=text_col))
    root = connected(docs, nodes, text_col=text_col, threshold=threshold)
    by_node = nodes.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    rooted = stored(by_node.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")))
    named = rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    of_node = rooted.select("node", "root").join(named, "root")
    return nodes.select("doc_id", "node").join(of_node, "node").select("doc_id", "node", "root", "class_id", "class_size")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The document of the least doc_id of each class (a row that repeats: once)."""
    of = classes(docs, doc_id=doc_id, text_col=text_col, threshold=threshold)
    # Several nodes of one class under its id (ids that repeat): the least node.
    least = of.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("doc_id", "root").agg(F.min(F.struct("node")).alias("f"), F.count("*").alias("rows"))
    kept = stored(least.select(F.col("doc_id").alias("_i"), F.col("f.node").alias("_n"), "rows"))
    names, own = docs.columns, fresh("node", docs.columns)
    keyed = with_node(docs, text_col, own)
    rows = fresh("rows", keyed.columns)
    kept = kept.select(F.col("_i").alias(fresh("_i", keyed.columns)), F.col("_n").alias(fresh("_n", keyed.columns)), F.col("rows").alias(rows))
    both = keyed.join(kept, keyed[doc_id].eqNullSafe(kept[kept.columns[0]]) & (keyed[own] == kept[kept.columns[1]]))
    # Only rows that may repeat are dealt out once more.
    return both.where(F.col(rows) == 1).select(*names).unionByName(both.where(F.col(rows) > 1).dropDuplicates([doc_id, own]).select(*names))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs).select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
