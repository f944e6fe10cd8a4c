"""Tables of results, kept as Parquet folders: versions of parts. A write makes a part or a version of its own and never touches
what is being read; what a write that failed has left behind is not read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RETRIED = ["no_match", "skipped_not_whitelisted", "skipped_junk"]
UNIQUE = ["moml_treatise", "moml_page", "volume", "reporter_abbr", "page"]


class Table:
    """A Parquet table by versions and parts: replace() begins the next version, append() adds a part to the current one."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        """Of the sub-folders prefix=n."""
        if not self._fs.exists(self._path(folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(folder))]
        return sorted(int(x.partition("=")[2]) for x in names if x.startswith(f"{prefix}="))

    def _parts(self, version: int) -> list[str]:
        folder = f"{self.path}/v={version}"
        return [f"{folder}/p={p}" for p in self._numbers(folder, "p") if self._fs.exists(self._path(f"{folder}/p={p}/_SUCCESS"))]

    def version(self) -> int:
        """The last version whose first part is complete; 0 if there is none."""
        return max((v for v in self._numbers(self.path, "v") if self._fs.exists(self._path(f"{self.path}/v={v}/p=0/_SUCCESS"))), default=0)

    def read(self) -> DataFrame:
        v = self.version()
        return self.spark.read.schema(self.schema).parquet(*self._parts(v)) if v else self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, version: int, part: int) -> None:
        fields = self.spark.createDataFrame([], self.schema).schema
        rows.select(*[F.col(f.name).cast(f.dataType) for f in fields]).write.mode("overwrite").parquet(f"{self.path}/v={version}/p={part}")

    def append(self, rows: DataFrame) -> None:
        v = self.version()
        self._write(rows, v or 1, max(self._numbers(f"{self.path}/v={v}", "p"), default=-1) + 1 if v else 0)

    def replace(self, rows: DataFrame) -> None:
        self._write(rows, max(self._numbers(self.path, "v"), default=0) + 1, 0)


def new_citations(old: DataFrame, rows: DataFrame) -> DataFrame:
    """The citations whose unique key isn't in old, one of each (that of the least id)."""
    first = rows.groupBy(*UNIQUE).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in UNIQUE]), "id").alias("r")).select(*UNIQUE, "r.*")
    cond = F.lit(True)
    for k in UNIQUE:
        cond = cond & first[k].eqNullSafe(old[k])
    return first.join(old, cond, "left_anti").select(*rows.columns)


def save_citations(table: Table, rows: DataFrame) -> None:
    """Add the citations whose unique key isn't there yet."""
    table.append(new_citations(table.read(), rows))


def new_links(old: DataFrame, rows: DataFrame) -> DataFrame:
    """One link of each citation that has none in old; an empty tier is null."""
    fresh = rows.dropDuplicates(["citation_id"]).join(old.select("citation_id"), "citation_id", "left_anti")
    return fresh.withColumn("match_tier", F.nullif("match_tier", F.lit("")))


def save_links(table: Table, rows: DataFrame) -> None:
    """Add the links of citations that have none; an empty tier is null."""
    table.append(new_links(table.read(), rows))


def kept_by_reset(links: DataFrame) -> DataFrame:
    return links.where(~F.col("status").isin(RETRIED))


def reset(table: Table) -> int:
    """Drop the links that a later run may improve; how many they were."""
    old = table.read()
    n = old.where(F.col("status").isin(RETRIED)).count()
    if n:
        table.replace(kept_by_reset(old))
    return n


def without(rows: DataFrame, bad: DataFrame, *keys: str) -> DataFrame:
    """A targeted delete."""
    return rows.join(bad.select(*keys).distinct(), list(keys), "left_anti")


def seed(table: DataFrame, new: DataFrame, parents: DataFrame) -> DataFrame:
    """Alternates to add: of known reporters, other than their own names, and not there yet."""
    ok = new.where("reporter_standard <> alt_abbr").join(parents.select("reporter_standard"), "reporter_standard", "left_semi").distinct()
    return ok.join(table, ["reporter_standard", "alt_abbr"], "left_anti")


def letterless_junk(unlinked: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Spellings without a letter that aren't in the whitelist, as junk."""
    found = unlinked.where(~F.col("reporter_abbr").rlike("[A-Za-z]")).select(F.col("reporter_abbr").alias("reporter_found")).distinct()
    return found.join(whitelist, "reporter_found", "left_anti").select("reporter_found", F.lit(None).cast("string").alias("reporter_standard"), F.lit(True).alias("junk"))
