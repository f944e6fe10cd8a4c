"""Browse and detail queries. Every limit has a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import linked_percent, match_score, normalize_reporter
from .views import joined, n, unmatched

#: Page sizes and limits.
TREATISES_PER_PAGE, CASES_PER_PAGE, NORMALIZED_PER_PAGE = 100, 100, 200
REPORTER_CITES, UNWHITELISTED, UNMATCHED, UNMATCHED_CITES, CITING_PAGES, NORMALIZED_CITES, MATCHES = 10_000, 250, 1000, 10_000, 2000, 5000, 20
LEAST_SCORE = 30
SORTS = {"cites": ("n", True), "year": ("year", False), "title": ("title", False)}


def last(name: str, descending: bool = False) -> Column:
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()


def one_line(raw: Column) -> Column:
    return F.translate(raw, "\n\r", "  ")


def page_of(df: DataFrame, page: int, size: int) -> DataFrame:
    return df.offset((max(1, page) - 1) * size).limit(size)


def citation_detail(unlinked, links, cap_cases, code_reporter, english, book_info, book_citation, page, ocr, citation_ids: DataFrame) -> DataFrame:
    """The detail rows of some citations (id)."""
    return (
        unlinked.join(citation_ids, "id", "left_semi")
        .join(links.withColumnRenamed("citation_id", "id"), "id", "left")
        .join(cap_cases.select(F.col("id").alias("cap_case_id"), F.col("name").alias("cap_name"), F.col("decision_year").alias("cap_year"), "frontend_url"), "cap_case_id", "left")
        .join(code_reporter.select(F.col("id").alias("code_reporter_id"), F.col("name").alias("code_name"), "official_citation"), "code_reporter_id", "left")
        .join(english.select(F.col("id").alias("er_case_id"), "er_name", "er_cite"), "er_case_id", "left")
        .join(book_info.withColumnRenamed("psmid", "moml_treatise"), "moml_treatise", "left")
        .join(book_citation.select(F.col("psmid").alias("moml_treatise"), "displaytitle", "author_composed"), "moml_treatise", "left")
        .join(page.select(F.col("psmid").alias("moml_treatise"), F.col("pageid").alias("moml_page"), "sourcepage"), ["moml_treatise", "moml_page"], "left")
        .join(ocr.select(F.col("psmid").alias("moml_treatise"), F.col("pageid").alias("moml_page"), "ocrtext"), ["moml_treatise", "moml_page"], "left")
        .select("id", "raw", "moml_treatise", "moml_page", "status", "cite_linked", "cap_name", "cap_year", "frontend_url", "code_name", "official_citation", "er_name", "er_cite", "bibliographicid", "year", "displaytitle", "author_composed", "productlink", "sourcepage", "ocrtext")
    )


def reporter_standards(reporters: DataFrame, whitelist: DataFrame) -> DataFrame:
    return reporters.join(whitelist, "reporter_standard", "left").groupBy("reporter_standard", "reporter_title").agg(F.count("reporter_found").alias("n"))


def reporter_variants(whitelist: DataFrame, standard: str) -> DataFrame:
    return whitelist.where(F.col("reporter_standard") == standard).select("reporter_found").orderBy("reporter_found")


def cites_for_reporter(unlinked: DataFrame, links: DataFrame, whitelist: DataFrame, standard: str) -> DataFrame:
    own = whitelist.where(F.col("reporter_standard") == standard).select(F.col("reporter_found").alias("reporter_abbr"))
    rows = joined(links, unlinked, "left").join(own, "reporter_abbr").select("id", one_line(F.col("raw")).alias("raw"), "status", "moml_treatise", "moml_page")
    return rows.orderBy("id").limit(REPORTER_CITES)


def unwhitelisted(unlinked: DataFrame, whitelist: DataFrame) -> DataFrame:
    rest = unlinked.join(whitelist.select(F.col("reporter_found").alias("reporter_abbr")), "reporter_abbr", "left_anti")
    return rest.groupBy("reporter_abbr").agg(n()).orderBy(F.desc("n"), "reporter_abbr").limit(UNWHITELISTED)


def cap_standards(reporters: DataFrame) -> DataFrame:
    return reporters.where("reporter_cap <> ''").select("reporter_standard", "reporter_cap")


def fuzzy_matches(abbrs: DataFrame, standards: DataFrame) -> DataFrame:
    """The best standards for each abbreviation. A score of LEAST_SCORE needs a common character, or an empty spelling, which is
    the beginning of any other: only such pairs are made and scored, each once."""
    a = abbrs.select("reporter_abbr", normalize_reporter(F.col("reporter_abbr")).alias("a"))
    b = standards.select("reporter_standard", normalize_reporter(F.col("reporter_standard")).alias("b"))
    none, empty = F.lit("\n"), F.lit("")  # the mark of an empty standard, and that of an empty abbreviation
    chars = lambda c: F.array_remove(F.array_distinct(F.split(c, "")), "")
    left = a.select("a", F.explode(F.concat(chars(F.col("a")), F.array(none), F.when(F.col("a") == "", F.array(empty)).otherwise(F.array().cast("array<string>")))).alias("char")).distinct()
    right = b.select("b", F.explode(F.when(F.col("b") == "", F.array(none, empty)).otherwise(F.concat(chars(F.col("b")), F.array(empty)))).alias("char")).distinct()
    near = left.join(right, "char").select("a", "b").distinct()
    scored = near.withColumn("score", match_score(F.col("a"), F.col("b"))).where(F.col("score") >= LEAST_SCORE).join(a, "a").join(b, "b")
    best = Window.partitionBy("reporter_abbr").orderBy(F.desc("score"), "reporter_standard")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= MATCHES).select("reporter_abbr", "reporter_standard", "score", "rank")


def dashboard_totals(summary: DataFrame) -> DataFrame:
    """The summary in one row, with percentages of what could be linked."""
    of = lambda m: F.coalesce(F.max(F.when(F.col("metric") == m, F.col("n"))), F.lit(0))
    names = {"raw": "total_raw_cites", "cap": "linked_cap", "code": "linked_code_reporter", "er": "linked_english_reports", "no_match": "no_match", "junk": "skipped_junk", "unlisted": "skipped_not_whitelisted"}
    one = summary.agg(*[of(m).alias(k) for k, m in names.items()]).withColumn("linked", F.expr("cap + code + er")).withColumn("potential", F.expr("raw - junk"))
    share = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) * 100.0 / F.col(b), 1)).otherwise(F.lit(0.0))
    return one.withColumns({"linked_of_raw": share("linked", "raw"), "linked_of_potential": share("linked", "potential"), "cap_of_linked": share("cap", "linked")})


def dashboard_order(by_reporter: DataFrame) -> DataFrame:
    return by_reporter.withColumn("total", F.expr("linked + no_match + unprocessed")).orderBy(F.desc("total"), "reporter_standard")


def _volume_filter(which: str) -> Column:
    return {"multi": F.col("volume").isNotNull(), "single": F.col("volume").isNull()}.get(which, F.lit(True) if which == "all" else F.col("volume").isNotNull())


def top_unmatched(top: DataFrame, which: str = "multi") -> DataFrame:
    return top.where(_volume_filter(which)).orderBy(F.desc("n"), last("reporter_standard"), last("volume"), last("page")).limit(UNMATCHED)


def unmatched_summary(top: DataFrame, which: str = "multi") -> DataFrame:
    return top.where(_volume_filter(which)).agg(n("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("cites"))


def _enriched(rows: DataFrame, book_citation: DataFrame, page: DataFrame) -> DataFrame:
    return rows.join(book_citation.select(F.col("psmid").alias("moml_treatise"), "displaytitle"), "moml_treatise", "left").join(
        page.select(F.col("psmid").alias("moml_treatise"), F.col("pageid").alias("moml_page"), "sourcepage"), ["moml_treatise", "moml_page"], "left"
    )


def _counted(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first rows, or all without a limit, with the number of all; counted apart, so that no task sees them all."""
    top = rows if limit is None else rows.orderBy(last("displaytitle"), last("sourcepage"), "id").limit(limit)
    return top.crossJoin(rows.agg(n("total")))


def unmatched_cites(links, unlinked, whitelist, book_citation, page, *, standard: str, volume: int | None, page_no: int, limit: int | None = UNMATCHED_CITES) -> DataFrame:
    own = unmatched(links, unlinked, whitelist).where(F.col("reporter_standard").eqNullSafe(F.lit(standard)) & F.col("volume").eqNullSafe(F.lit(volume).cast("int")) & (F.col("page") == page_no))
    rows = _enriched(own.drop("page"), book_citation, page)
    return _counted(rows.select("id", one_line(F.col("raw")).alias("raw"), "status", "displaytitle", F.coalesce(F.nullif("sourcepage", F.lit("")), "moml_page").alias("sourcepage")), limit)


def normalized_cites(links, unlinked, book_citation, page, *, cite: str) -> DataFrame:
    own = joined(links, unlinked).where(F.col("cite_normalized") == cite)
    return _counted(_enriched(own, book_citation, page).select("id", "raw", "status", "displaytitle", "sourcepage"), NORMALIZED_CITES)


def us_treatise_list(us: DataFrame, counts: DataFrame, book_citation: DataFrame, *, q: str = "", sort: str = "cites", page: int = 1) -> DataFrame:
    chosen = us.where(F.col("title").ilike(f"%{q}%")) if q else us
    each = chosen.select("bibliographicid", F.explode("psmid").alias("moml_treatise")).join(counts, "moml_treatise")
    sums = each.groupBy("bibliographicid").agg(*[F.sum(c).alias(c) for c in ("n", "linked", "not_linked")])
    authors = book_citation.groupBy(F.col("psmid").alias("first")).agg(F.min("author_composed").alias("author"))
    rows = chosen.withColumn("first", F.get("psmid", F.lit(0))).join(sums, "bibliographicid", "left").join(authors, "first", "left")
    rows = rows.select("bibliographicid", "title", "year", "vols", "author", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "linked", "not_linked")]).withColumn("linked_pct", linked_percent(F.col("linked"), F.col("n")))
    key, down = SORTS.get(sort, SORTS["cites"])
    return page_of(rows.orderBy(last(key, down), "bibliographicid"), page, TREATISES_PER_PAGE)


def treatise_detail(works: DataFrame, unlinked: DataFrame, links: DataFrame, work: str) -> DataFrame:
    """Pages of a work with their counts."""
    own = works.where(F.col("bibliographicid") == work).select(F.explode("psmid").alias("moml_treatise"))
    linked = F.coalesce(F.col("status").like("linked_%"), F.lit(False))
    pages = joined(links, unlinked, "left").join(own, "moml_treatise", "left_semi").groupBy("moml_treatise", "moml_page").agg(n(), F.count_if(linked).alias("linked"), F.count_if(~linked).alias("not_linked"))
    return pages.withColumn("linked_pct", linked_percent(F.col("linked"), F.col("n")))


def treatise_page(unlinked: DataFrame, links: DataFrame, ocr: DataFrame, psmid: str, pageid: str) -> DataFrame:
    """A page's citations by their first place in the text; those not found come after, by id."""
    text = ocr.where((F.col("psmid") == psmid) & (F.col("pageid") == pageid)).select(F.col("psmid").alias("moml_treatise"), F.col("pageid").alias("moml_page"), "ocrtext")
    rows = joined(links, unlinked, "left").join(text, ["moml_treatise", "moml_page"])
    at = F.nullif(F.expr("locate(raw, coalesce(ocrtext, ''))"), F.lit(0))
    source = F.when(F.col("cap_case_id").isNotNull(), "cap").when(F.col("er_case_id").isNotNull(), "er").when(F.col("code_reporter_id").isNotNull(), "code")
    case = F.coalesce(F.col("cap_case_id").cast("string"), "er_case_id", F.col("code_reporter_id").cast("string"))
    return rows.select("id", "raw", "status", source.alias("source"), case.alias("case_id"), at.cast("long").alias("at")).orderBy(last("at"), "id")


def page_text(ocr: DataFrame, psmid: str, pageid: str) -> DataFrame:
    """One row, '' for a null text; a page that isn't there is an error."""
    own = ocr.where((F.col("psmid") == psmid) & (F.col("pageid") == pageid))
    one = own.agg(F.count("*").alias("rows"), F.max(F.coalesce("ocrtext", F.lit(""))).alias("ocrtext"))
    return one.select(F.when(F.col("rows") == 0, F.raise_error(F.lit("no such page"))).otherwise(F.col("ocrtext")).cast("string").alias("ocrtext"))


def top_cases(counts: DataFrame, cap_cases: DataFrame, english: DataFrame, code: DataFrame, page: int = 1) -> DataFrame:
    """The page of cases first, then what is known of them."""
    top = page_of(counts.orderBy(F.desc("page_count"), "source", "case_id"), page, CASES_PER_PAGE)
    facts = (
        cap_cases.select(F.lit("cap").alias("source"), F.col("id").cast("string").alias("case_id"), F.col("name_abbreviation").alias("name"), F.col("decision_year").alias("year"))
        .union(english.select(F.lit("er"), "id", "er_name", "er_year"))
        .union(code.select(F.lit("code"), F.col("id").cast("string"), "name", "decision_year"))
    )
    return top.join(facts, ["source", "case_id"], "left")


def case_detail(links, unlinked, book_info, book_citation, page, *, status: str, column: str, case_id: str, limit: int | None = CITING_PAGES) -> DataFrame:
    """The works that cite a case, with their pages in order: of the first pages, or of all without a limit."""
    own = joined(links, unlinked).where((F.col("status") == status) & (F.col(column).cast("string") == case_id))
    rows = _enriched(own.drop("page"), book_citation, page).join(book_info.select(F.col("psmid").alias("moml_treatise"), "bibliographicid"), "moml_treatise", "left")
    pages = (
        rows.groupBy("moml_treatise", "moml_page", "bibliographicid", "displaytitle", F.coalesce(F.nullif("sourcepage", F.lit("")), "moml_page").alias("sourcepage"))
        .agg(n("cites"))
        .withColumn("work", F.coalesce("bibliographicid", "moml_treatise"))
    )
    if limit is not None:
        pages = pages.orderBy("work", "moml_treatise", "moml_page", last("displaytitle")).limit(limit)
    return pages.groupBy("work").agg(F.min("displaytitle").alias("title"), F.sum("cites").alias("total"), n("page_count"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("moml_treatise", "moml_page"))), lambda x: F.concat_ws("/", x["moml_treatise"], x["moml_page"])), ";").alias("pages"))


def case_meta(cap_cases: DataFrame, cap_citations: DataFrame) -> DataFrame:
    """CAP cases with one cite, an official one if there is any."""
    cite = cap_citations.groupBy(F.col("case_id").alias("id")).agg(F.min(F.struct((F.col("type") != "official").alias("other"), "cite")).alias("c"))
    return cap_cases.join(cite, "id", "left").select("id", "name", "decision_year", F.col("c.cite").alias("cite"))


def normalized_list(counts: DataFrame, q: str = "", page: int = 1) -> DataFrame:
    return page_of(counts.where(F.col("cite_normalized").like(f"{q}%")).orderBy(F.desc("cite_count"), "cite_normalized"), page, NORMALIZED_PER_PAGE)
