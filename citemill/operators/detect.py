"""Detection of citations in page texts, with regular-expression functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import WS, clean_cite, collapse, single_volume_pattern, strip_interior_digits

#: The characters of an abbreviation, and the patterns of the two general detectors.
CHAR = r"[\p{L}\t\n\f\r .,&()]"
UNIT = rf"(?:{CHAR}|\p{{L}}[0-9]\p{{L}})"
EDITION = rf"((1st|2nd|3rd|[0-9]th){WS}ed.)??"
GENERIC = rf"[0-9]{{1,3}}{WS}+{CHAR}{{3,16}}{EDITION}{WS}+[0-9]{{1,4}}"
OCR_DIGIT = rf"[0-9]{{1,3}}{WS}+{UNIT}{{0,15}}\p{{L}}[0-9]\p{{L}}{UNIT}{{0,15}}{EDITION}{WS}+[0-9]{{1,4}}"
#: Where a window starts: at the last one to three digits before white space; its text is looked at without being consumed.
START = r"(?:(?<![0-9])(?=[0-9]{1,2}[\t\n\f\r ])|(?=[0-9]{3}[\t\n\f\r ]))(?=([\s\S]{1,25}))"
WINDOW_BYTES = 25


def _cut(w: Column) -> Column:
    """The first characters of a window that make at most WINDOW_BYTES bytes."""
    most = F.array_max(F.filter(F.sequence(F.lit(1), F.lit(WINDOW_BYTES)), lambda k: F.octet_length(F.left(w, k)) <= WINDOW_BYTES))
    return F.when(F.octet_length(w) <= WINDOW_BYTES, w).otherwise(F.left(w, most))


def windows(pages: DataFrame, text: str = "ocrtext") -> DataFrame:
    """pages with ord (the window's number) and w, at most 25 bytes from each window's start."""
    found = pages.where(F.col(text).isNotNull()).select("*", F.posexplode(F.regexp_extract_all(F.col(text), F.lit(START), F.lit(1))).alias("ord", "w"))
    return found.withColumn("w", _cut(F.col("w")))


def accepted(raw: Column) -> Column:
    return (raw != "") & ~raw.contains(" v. ") & ~raw.contains("Ex parte")


def windowed(found: DataFrame, pattern: str, detector: int) -> DataFrame:
    return found.withColumn("raw", F.regexp_extract("w", pattern, 0)).where(accepted(F.col("raw"))).withColumn("detector", F.lit(detector)).drop("w")


def _single_matches(abbrs: list[str], text: str) -> list[Column]:
    """For each abbreviation an array of (detector, ord, raw). A page is only searched for one whose first word it contains."""
    none = F.array().cast("array<string>")

    def numbered(k: int, raws: Column) -> Column:
        return F.transform(F.coalesce(raws, none), lambda r, i: F.struct(F.lit(k + 2).alias("detector"), i.alias("ord"), r.alias("raw")))

    return [numbered(k, F.when(F.contains(F.col(text), F.lit(a.split(" ")[0])), F.regexp_extract_all(F.col(text), F.lit(single_volume_pattern(a)), F.lit(0)))) for k, a in enumerate(abbrs)]


def single_volume(pages: DataFrame, abbrs: list[str], text: str = "ocrtext") -> DataFrame:
    """One detector for each abbreviation, in order. Patterns are constants of the plan; a page is read once for all of them."""
    if not abbrs:
        return pages.where("false").select("*", F.lit(0).alias("ord"), F.lit("").alias("raw"), F.lit(0).alias("detector"))
    found = pages.where(F.col(text).isNotNull()).select("*", F.explode(F.concat(*_single_matches(abbrs, text))).alias("x"))
    return found.select(*pages.columns, "x.ord", "x.raw", "x.detector").where(accepted(F.col("raw")))


def all_detectors(pages: DataFrame, abbrs: list[str], general: list[str], text: str = "ocrtext") -> DataFrame:
    """pages with ord, raw and detector: the general patterns (0, 1 ...) on windows and the abbreviations (2 ...), in one pass."""
    starts = F.regexp_extract_all(F.col(text), F.lit(START), F.lit(1))
    items = F.concat(F.transform(starts, lambda w, i: F.struct(F.lit(-1).alias("detector"), i.alias("ord"), w.alias("raw"))), *_single_matches(abbrs, text))
    each = pages.where(F.col(text).isNotNull()).select(*[c for c in pages.columns if c != text], F.explode(items).alias("x"))
    w = each.select("*", "x.ord", F.when(F.col("x.detector") < 0, _cut(F.col("x.raw"))).otherwise(F.col("x.raw")).alias("w"))
    one = lambda d, raw: F.struct(d.alias("detector"), raw.alias("raw"))
    matched = F.when(F.col("x.detector") < 0, F.array(*[one(F.lit(k), F.regexp_extract("w", p, 0)) for k, p in enumerate(general)])).otherwise(F.array(one(F.col("x.detector"), F.col("w"))))
    return w.select("*", F.explode(matched).alias("m")).where(accepted(F.col("m.raw"))).select(*[c for c in pages.columns if c != text], "ord", "m.raw", "m.detector")


def with_fields(found: DataFrame) -> DataFrame:
    """volume (null for a single-volume detector), reporter_abbr and page of each raw match."""
    m = collapse(F.col("raw"))
    volume, page = F.regexp_extract(m, r"^[0-9]+", 0), F.regexp_extract(m, r"[0-9]+\z", 0)
    single = F.col("detector") >= 2
    middle = F.regexp_replace(m, r"[0-9]+\z", "")
    abbr = F.when(single, middle).otherwise(F.regexp_replace(middle, r"^[0-9]+", ""))
    return found.withColumns(
        {
            "volume": F.when(~single, F.expr("try_cast(v AS int)".replace("v", "regexp_extract(regexp_replace(raw, '[\\\\t\\\\n\\\\f\\\\r ]+', ' '), '^[0-9]+', 0)"))),
            "page": page.cast("int"),
            "reporter_abbr": F.rtrim(F.trim(abbr), F.lit(" ,")),
        }
    )


def citation_id(*key: Column) -> Column:
    """A stable id of a citation's unique key."""
    return F.md5(F.concat_ws("|", *key))


def detect(pages: DataFrame, single_vol_abbrs: list[str] = (), *, general: list[str] = (GENERIC, OCR_DIGIT), treatise: str = "psmid", page_id: str = "pageid", text: str = "ocrtext") -> DataFrame:
    """pages -> id, moml_treatise, moml_page, raw, volume, reporter_abbr, page: of citations that repeat on a page, the first.

    The order is that of the detectors (generic, OCR digit, single-volume ones in order), then of the text.
    """
    own = pages.select(F.col(treatise).cast("string").alias("moml_treatise"), F.col(page_id).cast("string").alias("moml_page"), F.col(text).alias("ocrtext"))
    found = all_detectors(own, list(single_vol_abbrs), list(general))
    key = ["moml_treatise", "moml_page", "volume", "reporter_abbr", "page"]
    first = with_fields(found).groupBy(*key).agg(F.min(F.struct("detector", "ord", "raw")).alias("first"))
    ident = citation_id(F.col("moml_treatise"), F.col("moml_page"), F.coalesce("volume", F.lit(-1)).cast("string"), F.col("reporter_abbr"), F.col("page").cast("string"))
    return first.select(ident.alias("id"), "moml_treatise", "moml_page", F.col("first.raw").alias("raw"), "volume", "reporter_abbr", "page")


def single_volume_abbrs(reporters: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """(reporter_standard, abbreviation) of single-volume reporters and their other spellings."""
    one = reporters.where("single_vol")
    other = abbreviations.join(one.select("reporter_standard"), "reporter_standard").select("reporter_standard", F.col("alt_abbr").alias("abbreviation"))
    return one.select("reporter_standard", F.col("reporter_standard").alias("abbreviation")).union(other).distinct()


def yield_report(found: DataFrame, baseline: DataFrame, whitelist: DataFrame, top: int = 20) -> DataFrame:
    """What a detector adds to a baseline: new citations by spelling, and whether the whitelist links, rejects or lacks it."""
    key = ["moml_treatise", "moml_page", "volume", "reporter_abbr", "page"]
    same = [found[k].eqNullSafe(baseline[k]) for k in key]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    new = found.join(baseline, cond, "left_anti")
    known = new.join(whitelist, new.reporter_abbr == whitelist.reporter_found, "left")
    kind = F.when(F.col("reporter_found").isNull(), "absent").when(F.col("junk"), "junk").otherwise("linkable")
    return known.groupBy("reporter_abbr", kind.alias("kind")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reporter_abbr").limit(top)


def suggestions(found: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Spellings with a digit inside, without it, and what the whitelist has of that."""
    by = found.groupBy("reporter_abbr").agg(F.count("*").alias("n")).withColumn("stripped", strip_interior_digits(F.col("reporter_abbr"))).where("stripped <> reporter_abbr")
    kind = F.when(F.col("reporter_found").isNull(), "unresolved").when(F.col("junk"), "junk").when(F.col("reporter_found") == F.col("reporter_standard"), "canonical").otherwise("variant")
    return by.join(whitelist, by.stripped == whitelist.reporter_found, "left").select("reporter_abbr", "stripped", "n", "reporter_standard", kind.alias("kind"))


#: Fixed value: another reading counts from this share of the stripped spelling's citations.
OTHER_READING = 0.10
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ambiguous_spellings(proposed: DataFrame, counts: DataFrame, whitelist: DataFrame, least: float = OTHER_READING) -> DataFrame:
    """proposed (reporter_abbr, stripped, reporter_standard) -> (reporter_abbr, other, spelling, n): another reporter that a digit of
    the spelling may stand for, as a letter, and that is cited at least `least` times as often as the stripped spelling (which
    counts once at least). counts: (reporter_abbr, n)."""
    at = F.filter(F.sequence(F.lit(1), F.length("reporter_abbr")), lambda i: F.substr(F.col("reporter_abbr"), i, F.lit(1)).between("0", "9"))
    letters = F.array(*map(F.lit, LETTERS))
    read = proposed.withColumn("i", F.explode(at)).withColumn("c", F.explode(letters))
    read = read.withColumn("spelling", F.expr("concat(left(reporter_abbr, i - 1), c, substr(reporter_abbr, i + 1))")).drop("i", "c").distinct()
    real = whitelist.where("NOT junk AND reporter_standard IS NOT NULL").select(F.col("reporter_found").alias("spelling"), F.col("reporter_standard").alias("other"))
    n = counts.select(F.col("reporter_abbr").alias("spelling"), "n")
    base = counts.select(F.col("reporter_abbr").alias("stripped"), F.col("n").alias("base"))
    both = read.join(real, "spelling").where("other <> reporter_standard").join(n, "spelling").join(base, "stripped", "left")
    return both.where(F.col("n") >= least * F.greatest(F.coalesce("base", F.lit(1)), F.lit(1))).select("reporter_abbr", "other", "spelling", "n").distinct()


def unambiguous_suggestions(found: DataFrame, whitelist: DataFrame, counts: DataFrame) -> DataFrame:
    """The canonical suggestions that have no other reading."""
    proposed = suggestions(found, whitelist).where("kind = 'canonical'")
    return proposed.join(ambiguous_spellings(proposed, counts, whitelist).select("reporter_abbr"), "reporter_abbr", "left_anti")


def sampled_pages(pages: DataFrame, percent: float, seed: int = 1) -> DataFrame:
    """A share of the pages, each by a hash of its key."""
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", "psmid", "pageid", F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
    return pages.where(draw % 1_000_000 < int(percent * 10_000))


def rendered(unlinked: DataFrame) -> DataFrame:
    return unlinked.withColumn("cite", clean_cite(F.col("volume"), F.col("reporter_abbr"), F.col("page")))


def by_detector_order(found: DataFrame) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("moml_treatise", "moml_page").orderBy("detector", "ord")))
