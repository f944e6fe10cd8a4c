"""Intermediate tables in the cluster's shared folder, and connected components, which need them."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of small tables that one task writes.
ROWS_A_TASK = 200_000


def ensure_checkpoints(spark: SparkSession) -> str:
    """The shared folder that the session names. One of our own only in local mode, where it is unset; on a cluster that is an error."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not found and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(found or f"{tempfile.gettempdir()}/checkpoints/{uuid.uuid4().hex}")
        current = sc._jsc.sc().getCheckpointDir()
    return found or current.get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage; the rows go to the shared folder."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write the rows as a Parquet table in the shared folder and read it back (compressed, and it survives executors). The table
    stays until freed() or the end of the session."""
    spark = df.sparkSession
    path = f"{ensure_checkpoints(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_drop, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def freed(*tables: DataFrame) -> None:
    """Delete stored() tables that nothing reads any more."""
    for df in tables:
        _drop(df.sparkSession, df._folder)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session has ended: nothing can be cleaned up any more
        pass


def components(edges: DataFrame, name: str = "root") -> DataFrame:
    """(node, root): the least node that is connected to each node of the edges (a, b), as a stored() table.

    Every node joins its least neighbour, edges are renamed, and loops and repeats go, until no edge is left: an edge is joined
    once or a few times, however many rounds there are. Where nodes are hashes, a constant share of them goes in each round.
    A node whose only edges are loops is not in the result.
    """
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = stored(edges.where("a <> b").select(*ordered).distinct())
    steps: list[DataFrame] = []
    while not steps or left:
        left = edges.count()
        few = 1 + left // ROWS_A_TASK  # later rounds have few edges: no more tasks and files than they need
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        step = stored(ends.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("root")).coalesce(few))
        steps.append(step)
        renamed = edges
        for c in ("a", "b"):
            renamed = renamed.join(step.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")), c)
        fewer = stored(renamed.where("a_root <> b_root").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).select(*ordered).distinct().coalesce(few))
        freed(edges)
        edges = fewer
        left = edges.count()
    freed(edges)
    labels = steps.pop()
    while steps:
        far = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        step = steps.pop()
        named = stored(step.join(far, "root", "left").select("node", F.coalesce("far", "root").alias("root")).coalesce(1 + step.count() // ROWS_A_TASK))
        freed(labels, step)
        labels = named
    return _renamed(labels, name)


def _renamed(labels: DataFrame, name: str) -> DataFrame:
    out = labels.withColumnRenamed("root", name)
    out._folder = labels._folder
    return out


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is none of those taken (Spark's names don't tell cases apart)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name
