"""Linking of detected citations to cases through an ordered cascade of lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cite_reporter, cite_volume, clean_cite
from ..plans.scratch import freed, stored

#: Step -> (source, status, tier).
STEPS = {
    1: ("cap", "linked_cap", "cap_direct"),
    2: ("freelaw", "linked_cap", "cap_freelaw"),
    3: ("cap", "linked_cap", "cap_alt_spelling"),
    4: ("freelaw", "linked_cap", "cap_freelaw_alt_spelling"),
    5: ("code", "linked_code_reporter", "code_direct"),
    6: ("code", "linked_code_reporter", "code_alt_spelling"),
    7: ("er", "linked_english_reports", "er_direct"),
}
#: What the fate of a citation depends on, and the rows of fates that all tasks may have; of more, citations are dealt out to them.
KEY = ("volume", "reporter_abbr", "page")
FEW_FATES = 200_000


def whitelist_entries(whitelist: DataFrame, reporters: DataFrame, diffvols: DataFrame) -> DataFrame:
    """The whitelist with what its reporters say: uk, single_vol, cap_different, reporter_cap."""
    differs = diffvols.select("reporter_standard").distinct().withColumn("differs", F.lit(True))
    r = reporters.select("reporter_standard", "jurisdiction", "single_vol", "reporter_cap")
    return (
        whitelist.join(r, "reporter_standard", "left")
        .join(differs, "reporter_standard", "left")
        .select(
            "reporter_found",
            "reporter_standard",
            "junk",
            F.coalesce(F.col("jurisdiction").like("uk%"), F.lit(False)).alias("uk"),
            F.coalesce("single_vol", F.lit(False)).alias("single_vol"),
            F.coalesce("differs", F.lit(False)).alias("cap_different"),
            "reporter_cap",
        )
    )


def diffvol_map(diffvols: DataFrame) -> DataFrame:
    """(reporter_standard, volume) -> cap_vol, cap_reporter; of several the greatest."""
    full = diffvols.where("reporter_standard IS NOT NULL AND vol IS NOT NULL AND cap_vol IS NOT NULL")
    one = full.groupBy("reporter_standard", F.col("vol").alias("volume")).agg(F.max(F.struct("cap_vol", "cap_reporter")).alias("d"))
    return one.select("reporter_standard", "volume", "d.cap_vol", "d.cap_reporter")


def unambiguous(pairs: DataFrame, ref: str) -> DataFrame:
    """(cite, ref) of the cites that stand for exactly one ref."""
    return pairs.groupBy("cite").agg(F.min(ref).alias(ref), F.max(ref).alias("_max")).where(F.col(ref) == F.col("_max")).drop("_max")


def code_cites(code_reporter: DataFrame) -> DataFrame:
    official = code_reporter.select(F.col("official_citation").alias("cite"), "id")
    parallel = code_reporter.select(F.explode(F.split("parallel_citation", ";")).alias("cite"), "id")
    bare = F.trim(F.regexp_replace(F.trim(F.col("cite")), r" \([0-9]{4}\)$", ""))
    return unambiguous(official.unionAll(parallel).withColumn("cite", bare).where("cite <> ''"), "id")


def english_cites(english_reports: DataFrame) -> DataFrame:
    """cite -> id; of several the least."""
    both = english_reports.select(F.col("er_cite").alias("cite"), "id").unionAll(english_reports.select("er_parallel_cite", "id"))
    return both.where("cite IS NOT NULL").groupBy("cite").agg(F.min("id").alias("id"))


def spellings(abbreviations: DataFrame) -> DataFrame:
    """reporter_standard -> its other spellings, in order of their bytes."""
    return abbreviations.groupBy("reporter_standard").agg(F.array_sort(F.collect_list("alt_abbr")).alias("alts"))


def lookup(cap_citations: DataFrame, freelaw_to_cap: DataFrame, code_reporter: DataFrame, english_reports: DataFrame) -> DataFrame:
    """All lookups as one table: source, cite, ref (string)."""
    parts = {
        "cap": unambiguous(cap_citations.select("cite", "case_id"), "case_id").select("cite", F.col("case_id").cast("string").alias("ref")),
        "freelaw": freelaw_to_cap.select("cite", F.col("cap_case_id").cast("string").alias("ref")),
        "code": code_cites(code_reporter).select("cite", F.col("id").cast("string").alias("ref")),
        "er": english_cites(english_reports).select("cite", F.col("id").alias("ref")),
    }
    return reduce(DataFrame.unionAll, [df.select(F.lit(s).alias("source"), "cite", "ref") for s, df in parts.items()])


def volume_forms(volume: Column, single_vol: Column) -> Column:
    """The volume as detected, then for single-volume reporters none for 1 and 1 for none."""
    form = lambda v: F.struct(v.cast("int").alias("v"))
    none = F.lit(None)
    return (
        F.when(single_vol & volume.isNull(), F.array(form(volume), form(F.lit(1))))
        .when(single_vol & (volume == 1), F.array(form(volume), form(none)))
        .otherwise(F.array(form(volume)))
    )


def link(unlinked: DataFrame, entries: DataFrame, diffvols: DataFrame, alternates: DataFrame, known: DataFrame) -> DataFrame:
    """citation_id, status, match_tier, cap_case_id, code_reporter_id, er_case_id, cite_cleaned, cite_normalized, cite_linked.

    Citations of one volume, spelling and page have one fate, which is found once and joined with them.
    """
    return links_of(unlinked, fates(unlinked, entries, diffvols, alternates, known))


def fates(unlinked: DataFrame, entries: DataFrame, diffvols: DataFrame, alternates: DataFrame, known: DataFrame) -> DataFrame:
    """KEY with the columns of link(), for all KEYs of the citations, as a stored table. The lookups by cite are stored before: two
    joins read them."""
    cites = stored(by_cite(known))
    out = stored(resolved(unlinked.select(*KEY).distinct(), entries, diffvols, alternates, cites))
    freed(cites)
    return out


def with_fates(unlinked: DataFrame, of: DataFrame) -> DataFrame:
    """The citations with their fates."""
    own = of.withColumnsRenamed({k: f"_{k}" for k in KEY})
    own = F.broadcast(own) if of.count() <= FEW_FATES else own
    return unlinked.join(own, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY])).drop(*[f"_{k}" for k in KEY])


def links_of(unlinked: DataFrame, of: DataFrame) -> DataFrame:
    """The rows of link(), of the citations' fates."""
    return with_fates(unlinked.select(F.col("id").alias("citation_id"), *KEY), of).drop(*KEY)


def by_cite(known: DataFrame) -> DataFrame:
    """The lookups (source, cite, ref), one row for each cite: cite, cap, freelaw, code, er."""
    return known.groupBy("cite").agg(*[F.min(F.when(F.col("source") == s, F.col("ref"))).alias(s) for s in ("cap", "freelaw", "code", "er")])


def resolved(asked: DataFrame, entries: DataFrame, diffvols: DataFrame, alternates: DataFrame, cites: DataFrame) -> DataFrame:
    """asked (volume, reporter_abbr, page), distinct, and the lookups of by_cite() -> asked with the columns of link().

    Each is exploded into one probe for each string that may stand for it; one join with the lookups by cite finds all hits, of
    which the least in (form, step, spelling) wins.
    """
    gated = asked.join(entries, F.col("reporter_abbr") == F.col("reporter_found"), "left")
    skipped = gated.where("reporter_found IS NULL OR junk").select(
        "volume", "reporter_abbr", "page", F.when(F.col("reporter_found").isNull(), "skipped_not_whitelisted").otherwise("skipped_junk").alias("status")
    )
    vols = diffvol_map(diffvols)
    open_ = gated.where("NOT junk").join(alternates, "reporter_standard", "left").withColumn("alts", F.coalesce("alts", F.array().cast("array<string>")))
    form = (
        open_.select("*", F.posexplode(volume_forms(F.col("volume"), F.col("single_vol"))).alias("form", "f"))
        .withColumnRenamed("volume", "detected")
        .withColumn("volume", F.col("f.v"))
        .join(vols, ["reporter_standard", "volume"], "left")
    )
    page = F.col("page")
    cleaned = clean_cite(F.col("volume"), F.col("reporter_standard"), page)
    cap = F.when(F.col("cap_different") & F.col("cap_vol").isNotNull(), clean_cite(F.col("cap_vol"), F.col("cap_reporter"), page)).otherwise(
        clean_cite(F.col("volume"), F.coalesce("reporter_cap", "reporter_standard"), page)
    )
    form = form.withColumns({"cleaned": cleaned, "normalized": F.when(F.col("uk"), cleaned).otherwise(cap)})
    # Kinds of probes: 0 the normalized cite, 1 the cleaned one, 2 the other spellings.
    probe = lambda kind, alt, cite: F.struct(F.lit(kind).alias("kind"), alt.alias("alt"), cite.alias("cite"))
    none = F.lit(0)
    us = F.concat(F.array(probe(0, none, F.col("normalized")), probe(1, none, F.col("cleaned"))), F.transform("alts", lambda a, i: probe(2, i, clean_cite(F.col("volume"), a, F.col("page")))))
    probes = form.withColumn("p", F.explode(F.when(F.col("uk"), F.array(probe(1, none, F.col("cleaned")))).otherwise(us))).select(
        "detected", "reporter_abbr", "page", "uk", "form", "cap_different", "cap_vol", "cleaned", "normalized", "p.kind", "p.alt", "p.cite"
    )
    routes = F.array_compact(F.array(F.when(F.coalesce("cap", "freelaw", "code").isNotNull(), False), F.when(F.col("er").isNotNull(), True)))
    keys = cites.select(F.explode(routes).alias("uk"), cite_volume(F.col("cite")).alias("key_volume"), cite_reporter(F.col("cite")).alias("key_reporter")).where("key_reporter IS NOT NULL")
    # One row for each reporter: whether it is known at all, and its volumes.
    volumes = keys.groupBy("uk", "key_reporter").agg(F.collect_set("key_volume").alias("volumes"))
    seen = (
        probes.withColumns({"key_volume": cite_volume(F.col("cite")), "key_reporter": cite_reporter(F.col("cite"))})
        .join(cites, "cite", "left")
        .join(volumes, ["uk", "key_reporter"], "left")
    )
    step = ref = F.lit(None)
    for s, (source, kind, uk) in reversed({1: ("cap", 0, False), 2: ("freelaw", 0, False), 3: ("cap", 2, False), 4: ("freelaw", 2, False), 5: ("code", 1, False), 6: ("code", 2, False), 7: ("er", 1, True)}.items()):
        hit = (F.col("kind") == kind) & (F.col("uk") == uk) & F.col(source).isNotNull()
        step, ref = F.when(hit, F.lit(s)).otherwise(step), F.when(hit, F.col(source)).otherwise(ref)
    seen = seen.withColumns({"step": step.cast("int"), "ref": ref.cast("string")})
    rank = F.when(F.col("ref").isNotNull(), F.struct("form", "step", "alt", "cite", "ref"))
    first = F.col("form") == 0
    out = seen.groupBy("detected", "reporter_abbr", "page").agg(
        F.min(rank).alias("hit"),
        F.first("uk").alias("uk"),
        F.bool_or(F.col("volumes").isNotNull()).alias("reporter"),
        F.coalesce(F.bool_or(F.array_contains("volumes", F.col("key_volume"))), F.lit(False)).alias("vol"),
        F.bool_or(F.col("cap_different") & F.col("detected").isNotNull() & first & F.col("cap_vol").isNull()).alias("no_diffvol"),
        F.max(F.when(first, F.col("cleaned"))).alias("cite_cleaned"),
        F.max(F.when(first, F.col("normalized"))).alias("cite_normalized"),
    )
    route = F.when(F.col("uk"), "uk").otherwise("us")
    miss = (
        F.when(~F.col("reporter"), F.concat(route, F.lit("_reporter_absent")))
        .when(~F.col("uk") & F.coalesce("no_diffvol", F.lit(False)), F.lit("us_diffvols_missing"))
        .when(~F.col("vol"), F.concat(route, F.lit("_volume_absent")))
        .otherwise(F.concat(route, F.lit("_page_absent")))
    )
    status, tier = F.lit("no_match"), miss
    for s, (_, st, ti) in STEPS.items():
        status, tier = F.when(F.col("hit.step") == s, st).otherwise(status), F.when(F.col("hit.step") == s, ti).otherwise(tier)
    linked = out.select(
        F.col("detected").alias("volume"),
        "reporter_abbr",
        "page",
        status.alias("status"),
        tier.alias("match_tier"),
        F.when(F.col("hit.step") <= 4, F.col("hit.ref")).cast("long").alias("cap_case_id"),
        F.when(F.col("hit.step").isin(5, 6), F.col("hit.ref")).cast("long").alias("code_reporter_id"),
        F.when(F.col("hit.step") == 7, F.col("hit.ref")).alias("er_case_id"),
        "cite_cleaned",
        "cite_normalized",
        F.col("hit.cite").alias("cite_linked"),
    )
    return linked.unionByName(skipped, allowMissingColumns=True)


def unprocessed(unlinked: DataFrame, links: DataFrame) -> DataFrame:
    """Citations without a link row."""
    return unlinked.join(links.select(F.col("citation_id").alias("id")), "id", "left_anti")
