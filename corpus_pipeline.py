"""A training corpus in five stages: language ID, line dedup, near dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; its result is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.

Defined results: documents without letters go in the first stage, null and empty texts among them; a null doc_id is held out of
the language model, the least id of its class only where there is no other, and sampled by the empty string; rows that repeat are
one from the third stage on; an empty table stays empty; of columns beyond those of documents, those named as the last stage's
results are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citemill.llm import decontaminate, language_id, line_dedup, mixing, near_dedup
from citemill.llm.common import freed, stored, table

#: Language ID rejects a text without letters and one whose score falls below this.
LEAST_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; the column lang stays as it is."""
    model = language_id.fit(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"), key=F.col("doc_id"))
    judged = language_id.predict(docs, model)
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents or more have; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the least doc_id."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage beyond the coverage limit, without the passages that reach the length limit;
    n_chars follows the text."""
    cut = decontaminate.judged(docs, table(spark, sf_dir, "benchmark"), cut=decontaminate.WINDOW).where(~F.col("contaminated"))
    n_chars = F.when(F.col("n_hit") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents, with topic, tokens, probability and weight."""
    results = ["tokens", "topic", "probability", "weight"]
    out = mixing.mixed(docs, text_out=True).where("sampled")
    return out.select(*[c for c in docs.columns if c.lower() not in results], *results)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

#: The learned classifier and the near-duplicate classes are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        last, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
            if k:
                freed(last)
    return docs
