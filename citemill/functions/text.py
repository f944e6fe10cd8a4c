"""Column functions on citation text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the patterns have it.
WS = r"[\t\n\f\r ]"


def correct_ocr(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Replace literal mistakes, rule by rule: later rules see what earlier ones have made."""
    if any(not m for m, _ in rules):
        raise ValueError("a rule needs a mistake to replace")
    for mistake, correction in rules:
        text = F.replace(text, F.lit(mistake), F.lit(correction))
    return text


def collapse(s: Column) -> Column:
    return F.regexp_replace(s, f"{WS}+", " ")


def clean_reporter(s: Column) -> Column:
    """One space for white space, one period for several, a space after a period that had one."""
    return F.regexp_replace(F.regexp_replace(collapse(s), rf"\.+{WS}", ". "), r"\.+", ".")


def clean_cite(volume: Column, reporter: Column, page: Column) -> Column:
    """`volume reporter page`, without a null volume."""
    return F.concat_ws(" ", volume.cast("string"), reporter, page.cast("string"))


def strip_interior_digits(s: Column) -> Column:
    return F.regexp_replace(s, r"(?<=\p{L})[0-9](?=\p{L})", "")


def normalize_reporter(s: Column) -> Column:
    """For comparing spellings: no periods and commas, lower case, single spaces."""
    return F.regexp_replace(F.lower(F.trim(F.translate(s, ".,", ""))), " {2,}", " ")


def cite_volume(cite: Column) -> Column:
    """The volume of a cite string, '' if it has none, null if it isn't a cite."""
    head = F.regexp_extract(cite, r"(?s)^(.+) ([0-9]+)\z", 1)
    return F.when(head != "", F.regexp_extract(head, r"(?s)^([0-9]+) (.*)\z", 1))


def cite_reporter(cite: Column) -> Column:
    head = F.regexp_extract(cite, r"(?s)^(.+) ([0-9]+)\z", 1)
    rest = F.regexp_extract(head, r"(?s)^([0-9]+) (.*)\z", 2)
    return F.when(head != "", F.when(head.rlike(r"(?s)^[0-9]+ .*\z"), rest).otherwise(head))


def match_score(a: Column, b: Column) -> Column:
    """100 for equal spellings, 90 for a prefix, else the share of characters that stay, as a percentage cut to an integer."""
    longest = F.greatest(F.octet_length(a), F.octet_length(b))
    prefix = a.startswith(b) | b.startswith(a)
    near = F.when(longest == 0, 0).otherwise(((1 - F.levenshtein(a, b) / longest) * 100).cast("int"))
    return F.when(a == b, 100).when(prefix, 90).otherwise(near)


def linked_percent(linked: Column, n: Column) -> Column:
    return F.when(n == 0, F.lit(0).cast("long")).otherwise(((linked * 100 + (n / 2).cast("long")) / n).cast("long"))


def status_class(status: Column) -> Column:
    return F.when(status.startswith("linked_"), "linked").when(status == "no_match", "no-match").when(status == "skipped_junk", "junk").otherwise("other")


def page_link(base: Column, page_id: Column) -> Column:
    """A page's link: its number without zeros at either end."""
    return F.concat(base, F.lit("&pg="), F.ltrim(F.rtrim(page_id, F.lit("0")), F.lit("0")))


def volume_link(link: Column, host: str, user: str) -> Column:
    return F.replace(F.replace(link, F.lit("HOST"), F.lit(host)), F.lit("USER"), F.lit(user))


def highlighted(text: Column, raws: Column) -> Column:
    """HTML of a text with the distinct raws marked, longest first."""
    escape = lambda s: F.replace(F.replace(F.replace(F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&#34;")), F.lit("'"), F.lit("&#39;"))
    order = F.array_sort(F.transform(F.array_distinct(raws), lambda r: F.struct((-F.length(r)).alias("n"), r.alias("r"))))
    return F.aggregate(order, escape(text), lambda acc, x: F.replace(acc, escape(x["r"]), F.concat(F.lit("<mark>"), escape(x["r"]), F.lit("</mark>"))))


def single_volume_pattern(abbr: str) -> str:
    """The pattern of a single-volume reporter: no volume, a free ending, then a page. Word boundaries are those of ASCII."""
    flexible = re.escape(abbr).replace(r"\ ", r"[\t\n\f\r .]*")
    edge = "(?<![A-Za-z0-9_])" if re.match(r"[A-Za-z0-9_]", abbr) else "(?<=[A-Za-z0-9_])"
    return rf"{edge}{flexible}[A-Za-z0-9_]*[.,]*{WS}+[0-9]{{1,4}}"
