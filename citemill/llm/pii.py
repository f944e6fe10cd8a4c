"""Surrogates for personal data: keyed, type-consistent, format-preserving replacements, in SQL functions only.

Entities are found by one regular expression of bounded parts, so that no text makes it recurse or run away. A value's letters and
digits are enciphered by a keyed Feistel network whose symbols stay in their class (digit, vowel, consonant, hexadecimal letter,
Cyrillic letter, letter of the same 32 code points in any other script), so that case, script, separators and length stay. The
network is a permutation of the values of one shape: equal values have equal surrogates in every document (coreference), different
ones different surrogates (distinctness), without a table of pairs. What a kind asks for besides is a permutation too:

- card numbers keep their first digit, and whether their check digit is right; IBANs their country, and whether theirs are;
- addresses of hosts stay in their class (private, loopback, link-local, multicast, public) and keep the first number;
- social security numbers keep whether each of their parts is one that is given out;
- phone numbers keep their country code; mail addresses their last label, and those of one domain have one domain again;
  domains that are set aside for examples stay;
- a listed given name becomes another of the same gender and script by a keyed rotation of its list; other names are enciphered.
  Titles stand before a name and stay.

Collision checks: a surrogate that is a value of the corpus itself, or that of two values (an unlisted given name may become a listed
one), would stand for two things at once; redraws() finds such values with shuffles of distinct values and draws again, under
another key, and with_surrogates() takes what it found.
Each document counts the entities whose surrogate isn't distinct or is another value of the document (n_collisions).

Defined results: a null or empty text stays as it is, with no entities; a mail address longer than the standards allow is replaced
as far as they do; letters that have no upper case of one character (such as the German sharp s) stay; rows that repeat get equal
results; an empty table gives no rows; further columns pass through, but for those named as the results, which are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import freed, fresh, stored, table

#: Given names by script and gender.
NAMES = {
    "latin_f": (
        "Aisha Alice Amina Amy Anita Anna Barbara Carla Carol Chiara Clara Deborah Diana Elena Elizabeth Emily Emma Eva Fatima Giulia Hannah Helen Ines Ingrid Isabel Jane Jennifer "
        "Jessica Julia Karen Karin Katarzyna Laura Layla Linda Lisa Lucia Maria Marie Mary Mei Michelle Nancy Nora Olga Olivia Patricia Paula Priya Sandra Sarah Sofia Susan Yuki"
    ).split(),
    "latin_m": (
        "Adam Ahmed Albert Ali Andrew Anton Arjun Carlos Charles Daniel David Diego Edward Felix Frank George Giovanni Hans Henri Henry Hiroshi Jack James Jean John Jorge Joseph Juan Kevin "
        "Karl Lars Louis Luis Marco Mark Michael Mohammed Omar Pablo Paul Peter Pierre Rahul Richard Robert Stefan Steven Thomas Wei William Yusuf"
    ).split(),
    "cyrillic_f": "Анна Вера Дарья Екатерина Елена Ирина Мария Наталья Нина Ольга Светлана Софья Татьяна Юлия".split(),
    "cyrillic_m": "Александр Алексей Андрей Антон Борис Виктор Дмитрий Иван Игорь Максим Олег Павел Роман Сергей Юрий".split(),
}
#: What stands before a name; a period may follow.
TITLES = "Mr Mrs Ms Miss Dr Prof Sir Lord Lady Judge Herr Frau Sr Sra Srta Don Doña Mme Mlle Señor Señora Dott Signor Signora".split()
#: Domains that belong to nobody.
RESERVED = ["example.com", "example.net", "example.org"]
_WORD = r"\p{Lu}[\p{L}'’-]{1,40}"


def patterns(names: dict[str, list[str]] = NAMES) -> dict[str, str]:
    """Kind -> pattern, in the order in which they are tried at a place. No group repeats without a bound."""
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    first = "|".join(n for own in names.values() for n in own)
    return {
        "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+\.[A-Za-z0-9.-]{0,188}[A-Za-z0-9](?![A-Za-z0-9-])",
        "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{32})(?![0-9A-Za-z])",
        "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![0-9A-Za-z])",
        "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
        "ssn": r"(?<![0-9A-Za-z])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z])",
        "ip": rf"(?<![0-9.])(?:{octet}\.){{3}}{octet}(?![0-9]|\.[0-9])",
        "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9A-Za-z])|(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])",
        "name": rf"(?=\p{{Lu}})(?<!\p{{L}})(?:(?:{first}) {_WORD}|(?<=(?<!\p{{L}})(?:{'|'.join(TITLES)})[.]? ){_WORD}(?: {_WORD}){{0,2}})",
    }


_DIGITS, _VOWELS, _CONSONANTS, _HEX = "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "abcdef"
_LATIN_VOWELS, _LATIN_CONSONANTS = "àáâãäåæèéêëìíîïòóôõöøùúûüąęėįųūőűœ", "çñćčďđłńňřśšťźżğş"
_CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюя"


def _let(name: str, value: str, body: str) -> str:
    """SQL: body with the name bound to the value."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _stable(c: str) -> str:
    """SQL: whether c is a letter that case changes one to one."""
    return f"({c} RLIKE '^\\\\p{{L}}$' AND length(lower({c})) = 1 AND length(upper({c})) = 1 AND lower(upper({c})) = lower({c}) AND {c} IN (lower({c}), upper(lower({c}))))"


def _is_symbol(c: str) -> str:
    return f"({c} BETWEEN '0' AND '9' OR {c} BETWEEN 'A' AND 'Z' OR {c} BETWEEN 'a' AND 'z' OR ({c} > '~' AND {_stable(c)}))"


def _alphabet(c: str, hexadecimal: str) -> str:
    """SQL: the alphabet of the lower-case symbol c."""
    named = [_VOWELS, _CONSONANTS, _LATIN_VOWELS, _LATIN_CONSONANTS, _CYRILLIC]
    cases = "".join(f" WHEN instr('{a}', {c}) > 0 THEN '{a}'" for a in named)
    x = f"decode(unhex(lpad(hex(ascii({c}) div 32 * 32 + u), 8, '0')), 'UTF-32')"
    rest = f"array_join(filter(transform(sequence(0, 31), u -> {x}), x -> {_stable('x')} AND lower(x) = x AND instr('{''.join(named)}', x) = 0), '')"
    return f"CASE WHEN {c} BETWEEN '0' AND '9' THEN '{_DIGITS}' WHEN {hexadecimal} AND instr('{_HEX}', {c}) > 0 THEN '{_HEX}'{cases} ELSE {rest} END"


def _shifted(part: str, other: str, key: str, tweak: str, turn: str) -> str:
    """SQL: the symbols of part, each moved on in its alphabet by a keyed hash of the other half."""
    move = "cast(conv(substr(p, 2 * ((i - 1) % 32) + 1, 2), 16, 10) AS int)"
    symbol = _let("a", _alphabet(f"substr({part}, i, 1)", f"startswith({tweak}, 'secret')"), f"substr(a, (instr(a, substr({part}, i, 1)) - 1 + {move}) % length(a) + 1, 1)")
    pad = f"sha2(concat_ws('|', '{key}', {tweak}, {turn}, {other}), 256)"
    return _let("p", pad, f"if(length({part}) = 0, '', array_join(transform(sequence(1, greatest(length({part}), 1)), i -> {symbol}), ''))")


def _enciphered(value: str, key: str, tweak: str, rounds: int = 4) -> str:
    """SQL: value with its symbols enciphered; all else stays. tweak: SQL of a string that chooses the permutation. In each round
    the halves change places, so that after an even number of them every symbol is in its place."""
    state = "named_struct('l', left(s, length(s) div 2), 'r', substr(s, length(s) div 2 + 1))"
    enc = f"aggregate(sequence(0, {rounds - 1}), {state}, (h, turn) -> named_struct('l', h.r, 'r', {_shifted('h.l', 'h.r', key, tweak, 'turn')}), h -> concat(h.l, h.r))"
    new = "if(z = lower(z), substr(enc, acc.at, 1), upper(substr(enc, acc.at, 1)))"
    put = f"(acc, z) -> if({_is_symbol('z')}, named_struct('out', concat(acc.out, {new}), 'at', acc.at + 1), named_struct('out', concat(acc.out, z), 'at', acc.at))"
    chars = f"filter(split({value}, ''), c -> c <> '')"
    symbols = f"array_join(transform(filter(q, c -> {_is_symbol('c')}), c -> lower(c)), '')"
    return _let("q", chars, _let("s", symbols, _let("enc", enc, f"aggregate(q, named_struct('out', '', 'at', 1), {put}, acc -> acc.out)")))


def _luhn(digits: str) -> str:
    """SQL: the check digit of digits."""
    d = f"cast(substr({digits}, length({digits}) - x + 1, 1) AS int)"
    return f"((10 - aggregate(sequence(1, length({digits})), 0, (t, x) -> t + if(x % 2 = 1, if({d} > 4, 2 * {d} - 9, 2 * {d}), {d})) % 10) % 10)"


def _mod97(text: str) -> str:
    """SQL: the remainder by 97 of digits and letters, where A to Z are 10 to 35."""
    return f"aggregate(filter(split({text}, ''), c -> c <> ''), 0, (r, c) -> if(c BETWEEN '0' AND '9', (r * 10 + cast(c AS int)) % 97, (r * 100 + ascii(c) - 55) % 97))"


def _rotation(names: list[str], key: str, label: str) -> str:
    """SQL: a map of each name to the next one in a keyed order of the list."""
    order = sorted(names, key=lambda n: hashlib.sha256(f"{key}|{label}|{n}".encode()).digest())
    return ", ".join(f"'{a}', '{b}'" for a, b in zip(order, order[1:] + order[:1], strict=True))


def _turned(ranks: str, sizes: str, key: str, tweak: str, rounds: int = 3) -> str:
    """SQL: three numbers (an array of ranks in classes of the sizes), each moved on in turn by a keyed hash of the others."""
    others = "array_join(transform(h, (x, i) -> if(i = turn % 3, '', cast(x AS string))), ',')"
    move = f"cast(conv(substr(sha2(concat_ws('|', '{key}', {tweak}, turn, {others}), 256), 1, 12), 16, 10) AS bigint)"
    step = f"transform(h, (x, i) -> if(i = turn % 3, cast((x + {move}) % sizes[i] AS int), x))"
    return _let("sizes", sizes, f"aggregate(sequence(0, {3 * rounds - 1}), {ranks}, (h, turn) -> {step})")


def _ip(v: str, key: str, tweak: str) -> str:
    """SQL: the first number stays; the second within what is set aside of its network, or what isn't."""
    n = "cast(o[1] AS int)"
    special = f"CASE o[0] WHEN '172' THEN if({n} BETWEEN 16 AND 31, 1, 2) WHEN '169' THEN if({n} = 254, 3, 4) WHEN '192' THEN if({n} = 168, 5, 6) ELSE 0 END"
    rank = f"CASE k WHEN 1 THEN {n} - 16 WHEN 2 THEN if({n} > 31, {n} - 16, {n}) WHEN 3 THEN 0 WHEN 4 THEN if({n} > 254, {n} - 1, {n}) WHEN 5 THEN 0 WHEN 6 THEN if({n} > 168, {n} - 1, {n}) ELSE {n} END"
    back = "CASE k WHEN 1 THEN w[0] + 16 WHEN 2 THEN if(w[0] > 15, w[0] + 16, w[0]) WHEN 3 THEN 254 WHEN 4 THEN if(w[0] > 253, w[0] + 1, w[0]) WHEN 5 THEN 168 WHEN 6 THEN if(w[0] > 167, w[0] + 1, w[0]) ELSE w[0] END"
    sizes = "array(element_at(array(256, 16, 240, 1, 255, 1, 255), k + 1), 256, 256)"
    turned = _turned(f"array({rank}, cast(o[2] AS int), cast(o[3] AS int))", sizes, key, f"concat({tweak}, o[0], ':', k)")
    return _let("o", f"split({v}, '[.]')", _let("k", special, _let("w", turned, f"concat_ws('.', o[0], {back}, w[1], w[2])")))


def _ssn(v: str, key: str, tweak: str) -> str:
    """SQL: areas 000, 666 and 900 to 999, group 00 and serial 0000 are never given out; each part stays within its class."""
    a, g, s = (f"cast(o[{k}] AS int)" for k in range(3))
    bad = f"({a} = 0 OR {a} = 666 OR {a} >= 900)"
    rank = f"CASE WHEN {a} = 0 THEN 0 WHEN {a} = 666 THEN 1 WHEN {a} >= 900 THEN {a} - 898 WHEN {a} > 666 THEN {a} - 2 ELSE {a} - 1 END"
    back = "CASE WHEN bad THEN CASE w[0] WHEN 0 THEN 0 WHEN 1 THEN 666 ELSE w[0] + 898 END WHEN w[0] >= 665 THEN w[0] + 2 ELSE w[0] + 1 END"
    sizes = f"array(if(bad, 102, 898), if({g} = 0, 1, 99), if({s} = 0, 1, 9999))"
    turned = _turned(f"array({rank}, greatest({g} - 1, 0), greatest({s} - 1, 0))", sizes, key, f"concat({tweak}, bad, {g} = 0, {s} = 0)")
    out = f"format_string('%03d-%02d-%04d', {back}, if({g} = 0, 0, w[1] + 1), if({s} = 0, 0, w[2] + 1))"
    return _let("o", f"split({v}, '-')", _let("bad", bad, _let("w", turned, out)))


def surrogate_sql(v: str, kind: str, key: str, draw: str = "0", names: dict[str, list[str]] = NAMES) -> str:
    """SQL: the surrogate of the value v of a kind, at a draw."""
    if any(c in text for text in [key, *(n for own in names.values() for n in own)] for c in "'\\"):
        raise ValueError("a key or name must not contain quotes or backslashes")
    tweak = f"concat({kind}, ':', {draw}, ':')"
    digits = f"regexp_replace({v}, '[^0-9]', '')"
    body = _enciphered("substr(d, 2, length(d) - 2)", key, tweak)
    number = _let("w", f"concat(left(d, 1), {body})", f"concat(w, cast((cast(right(d, 1) AS int) - {_luhn('left(d, length(d) - 1)')} + {_luhn('w')} + 10) % 10 AS string))")
    put = "(acc, z) -> if(z BETWEEN '0' AND '9', named_struct('out', concat(acc.out, substr(n, acc.at, 1)), 'at', acc.at + 1), named_struct('out', concat(acc.out, z), 'at', acc.at))"
    card = _let("d", digits, _let("n", number, f"aggregate(filter(split({v}, ''), c -> c <> ''), named_struct('out', '', 'at', 1), {put}, acc -> acc.out)"))
    country = f"regexp_extract({v}, '^[+][0-9]{{1,3}}', 0)"
    phone = _let("cc", country, f"concat(cc, {_enciphered(f'substr({v}, length(cc) + 1)', key, tweak)})")
    given = f"map({', '.join(_rotation(n, key, k) for k, n in names.items())})"
    first, rest = f"split({v}, ' ')[0]", f"substr({v}, length(split({v}, ' ')[0]) + 1)"
    name = f"concat(coalesce(element_at({given}, {first}), {_enciphered(first, key, tweak)}), {_enciphered(rest, key, tweak)})"
    domain, label = f"substring_index({v}, '@', -1)", f"substring_index({v}, '.', -1)"
    hidden = _enciphered(f"substr({domain}, 1, length({domain}) - length({label}) - 1)", key, f"concat({tweak}, 'domain')")
    new_domain = f"if(lower({domain}) IN ({', '.join(repr(r) for r in RESERVED)}), {domain}, concat({hidden}, '.', {label}))"
    mail = f"concat({_enciphered(f'substring_index({v}, {chr(39)}@{chr(39)}, 1)', key, tweak)}, '@', {new_domain})"
    check = lambda b: f"(98 - {_mod97(f'concat({b}, left({v}, 2), {chr(39)}00{chr(39)})')})"
    iban = _let("w", _enciphered(f"substr({v}, 5)", key, tweak), f"concat(left({v}, 2), lpad(cast((cast(substr({v}, 3, 2) AS int) - {check(f'substr({v}, 5)')} + {check('w')} + 100) % 100 AS string), 2, '0'), w)")
    return (
        f"CASE {kind} WHEN 'card' THEN {card} WHEN 'ip' THEN {_ip(v, key, tweak)} WHEN 'ssn' THEN {_ssn(v, key, tweak)} WHEN 'phone' THEN {phone} WHEN 'name' THEN {name} "
        f"WHEN 'email' THEN {mail} WHEN 'iban' THEN {iban} ELSE {_enciphered(v, key, tweak)} END"
    )


def _kind(v: Column, known: dict[str, str]) -> Column:
    """What is none of the other kinds is a name: its title isn't part of it."""
    out = F.lit("name")
    for kind, pattern in reversed([x for x in known.items() if x[0] != "name"]):
        out = F.when(v.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _entities(text: Column, known: dict[str, str], names: dict[str, list[str]]) -> Column:
    """(kind, value) of the entities of a text, in order; null if there is none."""
    some = "|".join([*(n for own in names.values() for n in own), *TITLES])
    hint = text.rlike("[0-9]{2}|@|[0-9][.]") | text.rlike(rf"(?=\p{{Lu}})(?<!\p{{L}})(?:{some})")
    values = F.regexp_extract_all(text, F.lit("|".join(known.values())), F.lit(0))
    return F.when(hint, F.transform(values, lambda v: F.struct(_kind(v, known).alias("kind"), v.alias("value"))))


def redraws(docs: DataFrame, *, key: str, text_col: str = "text", names: dict[str, list[str]] = NAMES, most: int = 4) -> DataFrame | None:
    """(kind, value, draw): the values whose surrogate at draw 0 is a value of docs or that of another value, with the first draw whose surrogate is neither
    that nor any other value's. A stored table; None without such values.

    A value that has no such draw (`a@example.com` in a corpus with all five vowels) stays at draw 0, where surrogates are distinct.
    """
    pairs = stored(docs.select(F.explode(_entities(F.col(text_col), patterns(names), names)).alias("e")).select("e.kind", "e.value").distinct())
    drawn = lambda df, draw: df.select("kind", "value", F.expr(surrogate_sql("value", "kind", key, draw, names)).alias("s"))
    first = stored(drawn(pairs, "0"))
    real = pairs.select("kind", F.col("value").alias("s"))
    twice = first.groupBy("kind", "s").agg(F.count("*").alias("n")).where("n > 1").select("kind", "s")
    open_ = stored(first.join(real.unionByName(twice), ["kind", "s"], "left_semi").select("kind", "value"))
    done, taken = None, first.select("kind", "s").unionByName(real)
    for draw in range(1, most + 1):
        if open_.isEmpty():
            break
        tried = drawn(open_, str(draw))
        clash = tried.groupBy("kind", "s").agg(F.count("*").alias("n")).where("n > 1").select("kind", "s").unionByName(tried.select("kind", "s").join(taken, ["kind", "s"], "left_semi")).distinct()
        good = stored(tried.join(clash, ["kind", "s"], "left_anti").withColumn("draw", F.lit(draw)))
        open_ = stored(open_.join(good, ["kind", "value"], "left_anti"))
        taken = taken.unionByName(good.select("kind", "s"))
        done = good if done is None else done.unionByName(good)
    out = None if done is None else stored(done.select("kind", "value", "draw"))
    freed(pairs, first)
    return out


def with_surrogates(docs: DataFrame, *, key: str, text_col: str = "text", names: dict[str, list[str]] = NAMES, redrawn: DataFrame | None = None) -> DataFrame:
    """docs with surrogates in the text, and entities (array of kind, value and surrogate), n_entities, n_collisions (long).
    redrawn: what redraws() gave for the whole corpus."""
    own = [c for c in docs.columns if c.lower() not in ("entities", "n_entities", "n_collisions")]
    known, e, draws = patterns(names), fresh("_e", own), fresh("_draws", own)
    text = F.col(text_col)
    found = docs.select(*own, _entities(text, known, names).alias(e))
    draw = "0"
    if redrawn is not None:
        by_text = found.select(F.md5(text).alias("t"), F.explode(e).alias("x")).select("t", "x.kind", "x.value").distinct().join(redrawn, ["kind", "value"])
        by_text = by_text.groupBy("t").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "value"), "draw"))).alias(draws)).withColumnRenamed("t", f"{draws}t")
        found = found.join(by_text, F.md5(text) == F.col(f"{draws}t"), "left").drop(f"{draws}t")
        draw = f"coalesce(element_at(`{draws}`, concat_ws('|', e.kind, e.value)), 0)"
    full = f"transform(`{e}`, e -> named_struct('kind', e.kind, 'value', e.value, 'surrogate', {surrogate_sql('e.value', 'e.kind', key, draw, names)}))"
    some = F.coalesce(F.size(e) > 0, F.lit(False))
    none = F.array().cast("array<struct<kind:string,value:string,surrogate:string>>")
    done = found.withColumn("entities", F.when(some, F.expr(full)).otherwise(none))
    gaps = F.split(text, "|".join(known.values()), -1)
    new = F.array_join(F.zip_with(gaps, F.col("entities.surrogate"), lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")
    out = done.withColumn(text_col, F.when(some, new).otherwise(text))
    distinct = F.array_distinct(F.transform("entities", lambda x: F.struct(x["kind"], x["value"])))
    after = F.array_distinct(F.transform("entities", lambda x: F.struct(x["kind"], x["surrogate"])))
    taken = F.size(F.array_intersect(F.array_distinct(F.col("entities.surrogate")), F.array_distinct(F.col("entities.value"))))
    clash = (F.size(distinct) - F.size(after) + taken).cast("long")
    return out.withColumns({"n_entities": F.size("entities").cast("long"), "n_collisions": F.when(some, clash).otherwise(F.lit(0).cast("long"))}).select(*own, "entities", "n_entities", "n_collisions")


#: A key for the query; a corpus that is given away has one of its own, kept secret.
KEY = "citemill-surrogates-1"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_surrogates(docs, key=KEY, redrawn=redraws(docs, key=KEY)).select("doc_id", "text", "n_entities", "n_collisions")
