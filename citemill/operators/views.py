"""The aggregates and views built on detected and linked citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .link import with_fates

PAGE = ("moml_treatise", "moml_page")
#: Subjects that aren't those of treatises on law in use.
EXCLUDED_SUBJECTS = ["UK", "Biography", "Collected Essays", "Trials"]
IRRELEVANT_TYPES = ["lexis", "west", "journal"]


def n(name: str = "n") -> Column:
    return F.count("*").alias(name)


def pages_distinct() -> Column:
    return F.count_distinct(F.struct(*PAGE)).alias("page_count")


def joined(links: DataFrame, unlinked: DataFrame, how: str = "inner") -> DataFrame:
    return unlinked.join(links.withColumnRenamed("citation_id", "id"), "id", how)


def reporter_abbreviations(cap_citations: DataFrame, cap_cases: DataFrame) -> DataFrame:
    forms = [r"^[0-9]+\s+(.+?)\s+[0-9]+[A-Za-z-]*$", r"^(.+?)\s+[0-9]+[A-Za-z-]*$", r"^[0-9]{4}-(.+?)-[0-9]+$"]
    abbr = F.coalesce(*[F.nullif(F.regexp_extract("cite", p, 1), F.lit("")) for p in forms])
    old = cap_cases.where("decision_year <= 1925").select(F.col("id").alias("case_id"))
    cites = cap_citations.where(~F.col("cite").like("%;%")).join(old, "case_id")
    return cites.select(abbr.alias("abbreviation")).where(F.col("abbreviation").rlike("^[A-Za-z]")).groupBy("abbreviation").agg(n()).where("n > 1")


def edges_with_metadata(edges: DataFrame, metadata: DataFrame) -> DataFrame:
    def side(end: str) -> DataFrame:
        return metadata.select(
            F.col("id").alias(f"{end}_id"),
            F.col("cites").alias(f"{end}_case_name"),
            F.col("jurisdiction_name").alias(f"{end}_jurisdiction"),
            F.col("jurisdiction_id").alias(f"{end}_jurisdiction_id"),
            F.col("decision_year").alias(f"{end}_year"),
            F.col("court_name_abbreviation").alias(f"{end}_court"),
            F.col("court_id").alias(f"{end}_court_id"),
        )

    e = edges.select(F.col("cites_from").alias("from_id"), F.col("cites_to").alias("to_id"))
    return e.join(side("from"), "from_id", "left").join(side("to"), "to_id", "left")


def freelaw_to_cap(freelaw: DataFrame, clusters: DataFrame, cap_citations: DataFrame) -> DataFrame:
    relevant = freelaw.where(~F.col("type").isin(IRRELEVANT_TYPES)).select("cite", "cluster_id")
    direct = clusters.where("cap_case_id IS NOT NULL").select("cluster_id", "cap_case_id")
    sibling = relevant.join(direct, "cluster_id", "left_anti").join(cap_citations, "cite").select("cluster_id", F.col("case_id").alias("cap_case_id"))
    cases = relevant.join(direct.union(sibling).distinct(), "cluster_id")
    return cases.groupBy("cite").agg(F.min("cap_case_id").alias("cap_case_id"), F.max("cap_case_id").alias("_m")).where("cap_case_id = _m").drop("_m")


def all_abbreviations(reporters: DataFrame, abbreviations: DataFrame) -> DataFrame:
    r = reporters.select("reporter_standard", "jurisdiction")
    other = abbreviations.join(r, "reporter_standard").where("alt_abbr IS NOT NULL").select(F.col("alt_abbr").alias("abbreviation"), "jurisdiction")
    both = r.withColumnRenamed("reporter_standard", "abbreviation").union(other).distinct()
    return both.withColumn("uk", F.col("jurisdiction").like("uk%"))


def cap_only_abbreviations(cap_abbrs: DataFrame, abbrs: DataFrame) -> DataFrame:
    return cap_abbrs.join(abbrs.where("NOT uk").select("abbreviation"), "abbreviation", "left_anti")


def own_only_abbreviations(abbrs: DataFrame, cap_abbrs: DataFrame) -> DataFrame:
    return abbrs.where("NOT uk").select("abbreviation").subtract(cap_abbrs.select("abbreviation"))


def top_reporters(unlinked: DataFrame) -> DataFrame:
    return unlinked.groupBy("reporter_abbr").agg(n())


def treatises(book_info: DataFrame, book_citation: DataFrame, book_subject: DataFrame) -> DataFrame:
    """By work. Subjects as a sorted set; a null among them, which the set can't hold, is told by has_null_subject."""
    vols = F.max(F.col("currentvolume").cast("int"))
    return (
        book_info.join(book_citation, "psmid", "left")
        .join(book_subject, "psmid", "left")
        .groupBy("bibliographicid")
        .agg(
            F.min("year").alias("year"),
            F.min("displaytitle").alias("title"),
            F.when(vols == 0, 1).otherwise(vols).alias("vols"),
            F.array_sort(F.collect_set("subject")).alias("subjects"),
            F.bool_or(F.col("subject").isNull()).alias("has_null_subject"),
            F.array_sort(F.collect_set("psmid")).alias("psmid"),
        )
    )


def us_treatises(works: DataFrame) -> DataFrame:
    """Works none of whose subjects is excluded or unknown, and whose title is known and not that of a speech."""
    subjects = ~F.arrays_overlap("subjects", F.array(*map(F.lit, EXCLUDED_SUBJECTS))) & ~F.col("has_null_subject")
    speech = F.col("title").rlike(r"(?i)\Woration\W|\Wremarks of\W|\Waddress\W")
    return works.where(subjects & ~speech).drop("has_null_subject")


def case_citation_counts(links: DataFrame, unlinked: DataFrame) -> DataFrame:
    """One pass for all three sources."""
    source = F.when(F.col("status") == "linked_cap", "cap").when(F.col("status") == "linked_english_reports", "er").when(F.col("status") == "linked_code_reporter", "code")
    case = F.when(F.col("source") == "cap", F.col("cap_case_id").cast("string")).when(F.col("source") == "er", F.col("er_case_id")).otherwise(F.col("code_reporter_id").cast("string"))
    return joined(links, unlinked).withColumn("source", source).where("source IS NOT NULL").groupBy("source", case.alias("case_id")).agg(pages_distinct(), n("cite_count"))


def citation_links_detail(links: DataFrame, unlinked: DataFrame, cap_cases: DataFrame, code_reporter: DataFrame, english: DataFrame) -> DataFrame:
    return (
        joined(links, unlinked)
        .join(cap_cases.select(F.col("id").alias("cap_case_id"), F.col("name").alias("cap_name")), "cap_case_id", "left")
        .join(code_reporter.select(F.col("id").alias("code_reporter_id"), F.col("name").alias("code_name")), "code_reporter_id", "left")
        .join(english.select(F.col("id").alias("er_case_id"), "er_name"), "er_case_id", "left")
        .select(
            F.col("id").alias("citation_id"),
            "status",
            F.col("raw").alias("cite_raw"),
            "cite_cleaned",
            "cite_normalized",
            "cite_linked",
            F.coalesce("cap_name", "code_name", "er_name").alias("case_name"),
            "cap_case_id",
            "code_reporter_id",
            "er_case_id",
        )
    )


def citation_links_status(links: DataFrame, unlinked: DataFrame) -> DataFrame:
    """Unprocessed ones by subtraction: every link has its citation."""
    rest = unlinked.agg(n("a")).crossJoin(links.agg(n("b"))).select(F.lit("unprocessed").alias("status"), F.expr("a - b").alias("n"))
    return links.groupBy("status").agg(n()).unionByName(rest)


def unmatched(links: DataFrame, unlinked: DataFrame, whitelist: DataFrame) -> DataFrame:
    real = whitelist.where("NOT junk").select(F.col("reporter_found").alias("reporter_abbr"), "reporter_standard")
    return joined(links, unlinked, "left").where("status IS NULL OR status = 'no_match'").join(real, "reporter_abbr")


def citations_unmatched_top(links: DataFrame, unlinked: DataFrame, whitelist: DataFrame, least: int = 5) -> DataFrame:
    return unmatched(links, unlinked, whitelist).groupBy("volume", "reporter_standard", "page").agg(n()).where(F.col("n") >= least)


def _whitelisted(links: DataFrame, unlinked: DataFrame, whitelist: DataFrame) -> DataFrame:
    real = whitelist.where("reporter_standard IS NOT NULL AND NOT junk").select(F.col("reporter_found").alias("reporter_abbr"), "reporter_standard")
    return joined(links, unlinked, "left").join(real, "reporter_abbr")


def dashboard_reporters(links: DataFrame, unlinked: DataFrame, whitelist: DataFrame, reporters: DataFrame) -> DataFrame:
    counts = _whitelisted(links, unlinked, whitelist).groupBy("reporter_standard").agg(
        F.count_if(F.col("status").like("linked%")).alias("linked"), F.count_if(F.col("status") == "no_match").alias("no_match"), F.count_if(F.col("status").isNull()).alias("unprocessed")
    )
    uk = reporters.select("reporter_standard", F.coalesce(F.col("jurisdiction").like("uk:%"), F.lit(False)).alias("uk"))
    return counts.join(uk, "reporter_standard")


def dashboard_summary(links: DataFrame, unlinked: DataFrame) -> DataFrame:
    total = unlinked.agg(n()).select(F.lit("total_raw_cites").alias("metric"), "n")
    return total.unionByName(links.groupBy(F.col("status").alias("metric")).agg(n()))


def dashboard_tiers(links: DataFrame, unlinked: DataFrame, whitelist: DataFrame) -> DataFrame:
    return _whitelisted(links, unlinked, whitelist).groupBy("reporter_standard", "status", "match_tier").agg(n())


def tier_summary(tiers: DataFrame) -> DataFrame:
    by = tiers.groupBy("status", "match_tier").agg(F.sum("n").alias("n"))
    share = F.round(F.lit(100).cast("decimal(20,1)") * F.col("n") / F.sum("n").over(Window.partitionBy("status")), 2).cast("double")
    return by.withColumn("pct_of_status", share).withColumn("status", F.coalesce("status", F.lit("unprocessed")))


def normalized_citation_counts(links: DataFrame, unlinked: DataFrame) -> DataFrame:
    return (
        joined(links, unlinked)
        .where("cite_normalized IS NOT NULL")
        .groupBy("cite_normalized")
        .agg(n("cite_count"), F.count_if(F.col("status").like("linked_%")).alias("linked_count"), pages_distinct())
    )


def treatise_citation_counts(links: DataFrame, unlinked: DataFrame) -> DataFrame:
    linked = F.coalesce(F.col("status").like("linked_%"), F.lit(False))
    return joined(links, unlinked, "left").groupBy("moml_treatise").agg(n(), F.count_if(linked).alias("linked"), F.count_if(~linked).alias("not_linked"))


def schools_to_textbooks(works: DataFrame, vols: DataFrame) -> DataFrame:
    each = works.select("workid", F.col("work_title").alias("title"), F.explode("moml_webids").alias("webid"))
    return each.join(vols.select("webid", "school"), "webid", "left").select("school", "workid", "title").distinct()


def single_volume_abbreviations(reporters: DataFrame, abbreviations: DataFrame) -> DataFrame:
    return reporters.where("single_vol").join(abbreviations, "reporter_standard", "left").select("alt_abbr", "reporter_title")


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(n("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_sizes(paths: dict[str, str], spark) -> DataFrame:
    """(table_name, bytes) of tables by their paths, and of all together as `total`; whatever file system they are in."""
    conf, sizes = spark.sparkContext._jsc.hadoopConfiguration(), {}
    for name, path in paths.items():
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        sizes[name] = p.getFileSystem(conf).getContentSummary(p).getLength()
    return spark.createDataFrame([*sizes.items(), ("total", sum(sizes.values()))], "table_name string, bytes long")


def coupled_treatises(links: DataFrame, unlinked: DataFrame, book_info: DataFrame) -> DataFrame:
    """Pairs of works that cite the same cases, both ways: how many. Each pair is counted once and then turned. links: of citations, or
    the fates of all citations of one volume, spelling and page, for which citations need no ids and mostly aren't dealt out."""
    from .coupling import project_dense

    work = book_info.select(F.col("psmid").alias("moml_treatise"), F.col("bibliographicid").alias("work"))
    each = joined(links, unlinked) if "citation_id" in links.columns else with_fates(unlinked, links)
    cites = each.where("status = 'linked_cap'").join(work, "moml_treatise").select("work", "cap_case_id")
    once = project_dense(cites, "work", "cap_case_id")
    way = lambda work, other: F.struct(F.col(work).alias("work"), F.col(other).alias("other"), "n")
    return once.select(F.inline(F.array(way("a", "b"), way("b", "a"))))


def project(pairs: DataFrame, node: str, shared: str) -> DataFrame:
    """(a, b, n): nodes that share neighbours, each pair once, with how many they share."""
    one = pairs.where(F.col(node).isNotNull() & F.col(shared).isNotNull()).select(node, shared).distinct()
    other = one.withColumnRenamed(node, "other")
    return one.join(other, shared).where(F.col(node) < F.col("other")).groupBy(F.col(node).alias("a"), F.col("other").alias("b")).agg(n())


def schools_to_cases(works: DataFrame, vols: DataFrame, links: DataFrame, unlinked: DataFrame) -> DataFrame:
    each = works.select("workid", F.explode("moml_webids").alias("webid")).join(vols.select("webid", "school", "psmid"), "webid", "left")
    cases = joined(links, unlinked).where("cap_case_id IS NOT NULL").groupBy(F.col("moml_treatise").alias("psmid"), "cap_case_id").agg(n())
    return each.join(cases, "psmid", "left").groupBy("school", "workid", "cap_case_id").agg(F.sum("n").alias("n"))


def volume_to_case(links: DataFrame, unlinked: DataFrame) -> DataFrame:
    return joined(links, unlinked).where("cap_case_id IS NOT NULL").groupBy("moml_treatise", "cap_case_id").agg(n())


def treatises_with_subjects(book_info: DataFrame, book_citation: DataFrame, book_subject: DataFrame) -> DataFrame:
    works = treatises(book_info, book_citation, book_subject)
    return works.where(~F.array_contains("subjects", "UK") & ~F.col("has_null_subject")).select("bibliographicid", "year", "title", "subjects")


#: Views that are stored: name -> those that must be refreshed before it.
REFRESH = {
    "reporter_abbreviations": [],
    "cap_to_cap_citations": [],
    "cite_to_cap": [],
    "all_page_id": [],
    "top_reporters": [],
    "case_citation_counts": [],
    "citations_unmatched_top": [],
    "dashboard_reporters": [],
    "dashboard_summary": [],
    "dashboard_tiers": [],
    "normalized_citation_counts": [],
    "treatise_citation_counts": [],
}


def refresh_levels(needs: dict[str, list[str]]) -> list[list[str]]:
    """The views that can be refreshed side by side, level by level."""
    levels: list[list[str]] = []
    done: set[str] = set()
    while len(done) < len(needs):
        ready = sorted(v for v, own in needs.items() if v not in done and done.issuperset(own))
        if not ready:
            raise ValueError("views need each other")
        levels.append(ready)
        done.update(ready)
    return levels
