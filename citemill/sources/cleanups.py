"""Preparation of side tables, and repairs of tables that are kept. Each function returns the whole new table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.link import code_cites
from .corpora import english_dates, first_by_key, strict_int


def without_ambiguous_cap_links(links: DataFrame, cap_citations: DataFrame) -> DataFrame:
    """Without links to a CAP case through a cite that stands for several cases."""
    several = cap_citations.groupBy("cite").agg(F.min("case_id").alias("lo"), F.max("case_id").alias("hi")).where("lo <> hi").select(F.col("cite").alias("cite_linked"), F.lit("linked_cap").alias("status"))
    return links.join(several, ["status", "cite_linked"], "left_anti").select(*links.columns)


def without_stale_code_links(links: DataFrame, code_reporter: DataFrame) -> DataFrame:
    """Without links to a code case through a cite that isn't one of its unambiguous ones (any more)."""
    known = code_cites(code_reporter).select(F.col("cite").alias("cite_linked"), F.lit(True).alias("_known"))
    both = links.join(known, "cite_linked", "left")
    return both.where("status <> 'linked_code_reporter' OR _known").select(*links.columns)


def without_stale_junk(links: DataFrame, unlinked: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Without `not whitelisted` on citations whose spelling has since become junk."""
    junk = whitelist.where("junk").select(F.col("reporter_found").alias("reporter_abbr"))
    stale = unlinked.join(junk, "reporter_abbr", "left_semi").select(F.col("id").alias("citation_id"), F.lit("skipped_not_whitelisted").alias("status"))
    return links.join(stale, ["citation_id", "status"], "left_anti").select(*links.columns)


def volumes_backfilled(unlinked: DataFrame, single_volume: DataFrame) -> DataFrame:
    """Volume 0 of a single-volume spelling (alt_abbr) is none."""
    one = single_volume.where("alt_abbr IS NOT NULL").select(F.col("alt_abbr").alias("reporter_abbr")).distinct().withColumn("_one", F.lit(True))
    both = unlinked.join(one, "reporter_abbr", "left")
    return both.withColumn("volume", F.when(F.col("_one") & (F.col("volume") == 0), None).otherwise(F.col("volume"))).select(*unlinked.columns)


def standards_by_title(diffvols: DataFrame, reporters: DataFrame) -> DataFrame:
    """reporter_standard copied from the reporter of the same title (the least of several); where there is none it stays."""
    named = reporters.where("reporter_title IS NOT NULL").groupBy("reporter_title").agg(F.min("reporter_standard").alias("_standard"))
    both = diffvols.join(named, "reporter_title", "left")
    return both.withColumn("reporter_standard", F.coalesce("_standard", "reporter_standard")).select(*diffvols.columns)


def to_jurisdictions(items: DataFrame, key: str) -> DataFrame:
    """(key, jurisdiction_id) of API records with an array of jurisdictions."""
    return items.select(F.col("id").alias(key), F.explode("jurisdictions").alias("j")).select(key, F.col("j.id").alias("jurisdiction_id"))


def blanks_as_null(items: DataFrame, *columns: str) -> DataFrame:
    """0 or '' of API records is null."""
    kinds = dict(items.dtypes)
    return items.withColumns({c: F.nullif(F.col(c), F.lit("" if kinds[c] == "string" else 0)) for c in columns})


def case_metadata(raw: DataFrame) -> DataFrame:
    """Metadata with decision_year and decision_date made of decision_date_original."""
    original = F.col("decision_date_original")
    return raw.withColumnRenamed("court__name_abbreviation", "court_name_abbreviation").withColumns({"decision_year": strict_int(F.substring(original, 1, 4)), "decision_date": F.try_to_date(original, "yyyy-MM-dd")})


def english_reports(raw: DataFrame) -> DataFrame:
    """Rows with a date, which is parsed; an empty name is null; the key columns first, without er_title."""
    first = ["er_id", "er_name", "er_year", "er_date", "er_cite", "er_cite_disambiguated", "er_parallel_cite", "murrell_uid", "murrell_year", "murrell_title"]
    rest = [c for c in raw.columns if c not in [*first, "er_title"]]
    clean = raw.withColumns({"er_date": english_dates(F.col("er_date")), "er_name": F.nullif("er_name", F.lit(""))})
    return clean.where("er_date IS NOT NULL").select(*first, *rest).withColumnRenamed("er_id", "id")


def whitelist(raw: DataFrame, order: str) -> DataFrame:
    """Trimmed spellings, flags that are not null, and the first row of each spelling in the file's order."""
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("statute", "uk", "junk") if c in raw.columns}
    return first_by_key(raw.withColumns({"reporter_found": F.trim("reporter_found"), **flags}), "reporter_found", order)
