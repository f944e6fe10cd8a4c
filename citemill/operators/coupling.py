"""Projections of dense bipartite graphs, counted block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans import scratch
from .views import n, project

#: Nodes of a block, as a mean: a task has the counts of one pair of blocks at a time.
BLOCK = 512
#: Neighbours whose incidence is multiplied at once; far below 2^24, so that 32-bit floats count them exactly.
CHUNK = 1024
MOST_TASKS = 2000


def project_dense(pairs: DataFrame, node: str, shared: str, block: int = BLOCK) -> DataFrame:
    """What project() returns. Where a self-join makes more rows than dealing each row to all pairs of blocks of nodes, such pairs
    are counted as products of incidence matrices: shuffled are the rows once for each block, and no pair before it is counted."""
    one = scratch.stored(pairs.where(F.col(node).isNotNull() & F.col(shared).isNotNull()).select(F.col(node).alias("node"), F.col(shared).alias("shared")).distinct())
    joins = one.groupBy("shared").agg(n("d")).agg(F.sum("d").alias("rows"), F.sum(F.col("d").cast("double") * (F.col("d") - 1) / 2).alias("joins")).first()
    blocks = -(-one.select("node").distinct().count() // block)
    if not joins.rows or joins.joins <= joins.rows * blocks:
        return project(one, "node", "shared")
    own = one.select("node").distinct().withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int"))
    numbered = own.withColumn("at", F.row_number().over(Window.partitionBy("block").orderBy("node")) - 1)
    members = one.join(numbered, "node").groupBy("block", "shared").agg(F.collect_list("at").alias("at"))
    names = numbered.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "node"))).alias("names")).select("block", F.col("names.node").alias("names"))
    both = names.unionByName(members, allowMissingColumns=True).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = both.select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).alias("right"), "shared", "at", "names")
    tasks = min(blocks * (blocks + 1) // 2, MOST_TASKS)
    kind = one.schema["node"].dataType.simpleString()
    counts = dealt.repartition(tasks, "i", "j").sortWithinPartitions("i", "j", "shared").mapInArrow(_counted, f"a {kind}, b {kind}, n long")
    return counts.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n")


class _Blocks:
    """The counts of a pair of blocks; rows come in the order of shared, those with names first."""

    def __init__(self, same: bool) -> None:
        self.same, self.names, self.last, self.row, self.count = same, {}, None, -1, None

    def name(self, right: bool, names: pa.Array) -> None:
        self.names[right] = names
        if len(self.names) == 2 - self.same:
            sizes = [len(self.names[k]) for k in (False, not self.same)]
            self.count = np.zeros(sizes, np.int64)
            self.left = np.zeros((CHUNK, sizes[0]), np.float32)
            self.right = self.left if self.same else np.zeros((CHUNK, sizes[1]), np.float32)

    def add(self, right: np.ndarray, shared: pa.Array, at: pa.ListArray) -> None:
        if self.count is None:  # the other block is empty
            return
        new = np.ones(len(shared), bool)
        new[0] = self.last is None or shared[0] != self.last
        new[1:] = pc.not_equal(shared[1:], shared[:-1]).to_numpy(zero_copy_only=False)
        self.last = shared[-1]
        row = self.row + np.cumsum(new)
        of, at = np.repeat(np.arange(len(row)), at.value_lengths().to_numpy()), at.flatten().to_numpy()
        done = 0
        while done < len(row):
            upto = int(np.searchsorted(row, CHUNK))  # rows of the neighbours that this chunk still takes
            a, b = np.searchsorted(of, (done, upto))
            to_right = right[of[a:b]]
            for side, mine in ((self.left, ~to_right), (self.right, to_right)):
                side[row[of[a:b]][mine], at[a:b][mine]] = 1
            if upto < len(row):
                self.multiply()
                row = row - CHUNK
            done = upto
        self.row = int(row[-1])

    def multiply(self) -> None:
        self.count += (self.left.T @ self.right).astype(np.int64)
        self.left[:] = 0
        self.right[:] = 0

    def result(self) -> Iterator[pa.RecordBatch]:
        if self.count is None:
            return
        self.multiply()
        i, j = np.nonzero(np.triu(self.count, 1) if self.same else self.count)
        yield pa.RecordBatch.from_arrays([self.names[False].take(pa.array(i)), self.names[not self.same].take(pa.array(j)), pa.array(self.count[i, j])], ["a", "b", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, now = None, None
    for batch in batches:
        i, j, right = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
        ends = np.flatnonzero((np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        for start, end in zip([0, *ends], [*ends, len(i)], strict=True):
            if start == end:
                continue
            if (int(i[start]), int(j[start])) != key:
                if now:
                    yield from now.result()
                key = int(i[start]), int(j[start])
                now = _Blocks(key[0] == key[1])
            while start < end and batch.column(3)[int(start)].as_py() is None:
                now.name(bool(right[start]), batch.column(5)[int(start)].values)
                start += 1
            if start < end:
                now.add(right[start:end], batch.column(3)[start:end], batch.column(4)[start:end])
    if now:
        yield from now.result()
