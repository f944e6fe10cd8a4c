"""Exports of tables: CSV and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of the two tables that are edited by hand.
WHITELIST = ["reporter_found", "reporter_standard", "junk"]
REPORTERS = ["reporter_standard", "reporter_title", "level", "jurisdiction", "year_start", "year_end", "single_vol", "type", "reporter_cap"]


def field(value: Column) -> Column:
    """A CSV field: in quotes, which are doubled, where it holds a comma, a quote or a new line; null is empty."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(text.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def csv_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """One line a row, without the header."""
    return df.select(F.concat_ws(",", *[field(F.col(c)) for c in columns]).alias("line"))


def whitelist_lines(rows: DataFrame) -> DataFrame:
    return csv_lines(rows, WHITELIST)


def statute_lines(rows: DataFrame) -> DataFrame:
    """Reporters for those rows that are statutes."""
    made = {"jurisdiction": F.when(F.col("uk"), "uk:").otherwise(""), "type": F.lit("statute"), **{c: F.lit("") for c in REPORTERS if c not in ("reporter_standard", "jurisdiction", "type")}}
    return csv_lines(rows.where("statute").select("reporter_standard", *[v.alias(c) for c, v in made.items()]), REPORTERS)


def json_rows(df: DataFrame, *columns: str) -> DataFrame:
    """One JSON object a row; null fields are null."""
    return df.select(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}).alias("json"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("emptyValue", "").mode("overwrite").csv(path)
