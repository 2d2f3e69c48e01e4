"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score.

Column expressions only; a text's spans come from one pass per pattern, and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.arrays import bind, blocks, cut, running

# The patterns of the four base kinds.  Their quantifiers are possessive where the
# next character can never belong to the repeated class, which changes no match but needs no
# backtracking on very long texts.  A match may start only at a run's first character or where
# the last match ended: a later start in the same run can match only if the first one does.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Proposals of the method beyond the base kinds.
# An account code is found by its first four characters; where it ends is decided by length and checksum.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
IBAN_REST = range(30, 10, -1)
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "IR IS TR", 27: "BF BI CF CG CM DJ FR GA GQ GR IT KM MC MG ML MR SM SN TD TG",
    28: "AL AZ BJ BY CI CY DO FK GT HN HU LB NE NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
LOCAL_PHONE = r"(?<![0-9+.()-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"

KINDS = ("email", "ip", "card", "phone")
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
#: Proposed kind: (pattern, kind reported, words that speak for it, score without them).
PROPOSED = {
    "iban": (IBAN, "iban", r"iban|account|konto|cuenta|compte|bank", 0.9),
    "local_phone": (LOCAL_PHONE, "phone", r"\b(?:tel|phone|call|fax|mobile|telefon|tél|teléfono)", 0.3),
}
CONTEXT = 40
CONTEXT_BONUS = 0.4
KEEP_FROM = 0.6


_MATCH = "struct<s:int,e:int,m:string>"


def _matches(text: Column, pattern: str) -> Column:
    """Matches as (s, e, m): start, end in code points and the matched text.

    The pieces between matches and the matches alternate, so positions are running sums of lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(found, F.split(text, pattern, -1), lambda m, b: F.struct(b.alias("b"), m.alias("m")))
    both = F.filter(both, lambda x: x["m"].isNotNull())

    def place(at, x):
        start = at + F.length(x["b"])
        end = start + F.length(x["m"])
        return end, F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m"))

    return running(both, F.lit(0), place, _MATCH)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn_valid(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""

    def add(total, i):
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97_valid(code: Column) -> Column:
    """Whether an account code without spaces passes the mod-97 checksum: moved round, letters as 10 to 35, it leaves 1."""
    moved = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))

    def add(rest, c):
        value = F.ascii(c)
        return F.when(value < 58, (rest * 10 + value - 48) % 97).otherwise((rest * 100 + value - 55) % 97)

    return F.aggregate(F.regexp_extract_all(moved, F.lit("."), F.lit(0)), F.lit(0), add) == 1


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
CONFIRMED = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    "card": lambda m: F.when(F.length(_digits(m)).between(14, 19), luhn_valid(_digits(m))).otherwise(F.lit(False)),
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
    "local_phone": lambda m: F.lit(True),
}
#: A character without which a text has no match, and per base kind the score and the words that speak for it.
NEEDED = {"email": "@", "ip": ".", "phone": "+"}
SCORES = {"email": 0.7, "ip": 0.6, "card": 0.8, "phone": 0.7}
CONTEXT_WORDS = {
    "email": r"\be-?mail|contact|correo|courriel",
    "ip": r"\bip\b|server|host|address",
    "card": r"card|visa|credit|karte|tarjeta|carte",
    "phone": r"\b(?:tel|phone|call|fax|mobile|telefon|tél|teléfono)",
}


def _accounts(text: Column, parts: Column) -> Column:
    """Account codes passing mod-97 as (s, e, m), leftmost first, none inside another.

    A following word or number may look like a part of the code, so every end where a word ends is tried:
    first that of the country's length, then the longest.
    """
    ends = [(f"(?:{names.replace(' ', '|')})", n - 4) for n, names in IBAN_COUNTRIES.items()]
    ends += [("[A-Z]{2}", n) for n in IBAN_REST]
    patterns = [rf"^{start}[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n}}}(?![A-Za-z0-9])" for start, n in ends]

    def whole(x):
        rest = cut(parts, x["s"], F.lit(6 + 2 * IBAN_REST[0]))
        tried = F.array(*[F.regexp_extract(rest, p, 0) for p in patterns])
        code = F.get(F.filter(tried, lambda c: mod97_valid(F.replace(c, F.lit(" "), F.lit("")))), F.lit(0))
        return F.struct(x["s"].alias("s"), (x["s"] + F.length(code)).alias("e"), code.alias("m"))

    found = F.filter(F.transform(_matches(text, IBAN), whole), lambda x: x["m"].isNotNull())

    def leftmost(at, x):
        free = at <= x["s"]
        return F.when(free, x["e"]).otherwise(at), F.struct(x.alias("x"), free.alias("free"))

    chosen = running(found, F.lit(0), leftmost, f"struct<x:{_MATCH},free:boolean>")
    return F.transform(F.filter(chosen, lambda c: c["free"]), lambda c: c["x"])


_SPAN = "struct<start:int,rank:int,end:int,kind:string,score:double,base:boolean>"


def _spans(text: Column, name: str, rank: int) -> Column:
    """Confirmed spans of one pattern as (start, rank, end, kind, score, base)."""
    if name in BASE:
        pattern, kind, words, score = BASE[name], name, CONTEXT_WORDS[name], SCORES[name]
    else:
        pattern, kind, words, score = PROPOSED[name]
    accept = lambda x: CONFIRMED[name](x["m"])

    def span(x, parts):
        low = F.greatest(x["s"] - CONTEXT, F.lit(0))
        near = F.concat_ws(" ", cut(parts, low, x["s"] - low), cut(parts, x["e"], F.lit(CONTEXT)))
        sure = F.lit(score) + F.when(F.lower(near).rlike(words), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
        return F.struct(
            x["s"].alias("start"), F.lit(rank).alias("rank"), x["e"].alias("end"), F.lit(kind).alias("kind"),
            F.least(sure, F.lit(1.0)).alias("score"), F.lit(name in BASE).alias("base"),
        )

    def read(parts):
        found = _accounts(text, parts) if name == "iban" else F.filter(_matches(text, pattern), accept)
        return F.transform(found, lambda x: span(x, parts))

    there = text.contains(NEEDED[name]) if name in NEEDED else text.rlike("[0-9]")
    return F.when(there, bind(blocks(text), read)).otherwise(F.expr(f"cast(array() as array<{_SPAN}>)"))


def _without_clashes(spans: Column) -> Column:
    """Base spans, and added ones that overlap none of them; ``spans`` is sorted by start, base spans first.

    One pass sees whether an earlier base span reaches into a span, one from the end whether a later one begins in it.
    """
    kind = f"struct<x:{_SPAN},clash:boolean>"

    def forth(reach, x):
        after = F.when(x["base"], F.greatest(reach, x["end"])).otherwise(reach)
        return after, F.struct(x.alias("x"), (reach > x["start"]).alias("clash"))

    def back(begin, m):
        x = m["x"]
        after = F.when(x["base"], F.least(begin, x["start"])).otherwise(begin)
        return after, F.struct(x.alias("x"), (m["clash"] | (begin < x["end"])).alias("clash"))

    marked = running(F.reverse(running(spans, F.lit(0), forth, kind)), F.lit((1 << 31) - 1), back, kind)
    kept = F.filter(F.reverse(marked), lambda m: m["x"]["base"] | ~m["clash"])
    return F.transform(kept, lambda m: m["x"])


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Add the array ``into`` of (start, rank, end, kind, score, base), sorted by start, then kind.

    Base kinds are email, ip (parts at most 255), card (14 to 19 digits passing Luhn) and phone
    (10 to 15 digits): leftmost matches that do not overlap within a kind, failing ones dropped;
    they stay whatever their score.  The method adds account codes passing mod-97 and phone
    numbers without a plus if the score with its context reaches ``KEEP_FROM`` and no base
    span overlaps.  Positions are code points, the end exclusive.

    A null or empty text has no spans.  Rows are independent: repeated rows give repeated
    results, an empty table none, other columns pass through (a column named ``into`` is replaced).
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    names = [*BASE, *PROPOSED]
    parts = {f"_pii_{n}": _spans(whole, n, i) for i, n in enumerate(names)}
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in parts.items()])
    base = F.concat(*[F.col(f"_pii_{n}") for n in BASE])
    more = F.filter(F.concat(*[F.col(f"_pii_{n}") for n in PROPOSED]), lambda x: x["score"] >= KEEP_FROM)
    rows = rows.withColumns({"_pii_base": base, "_pii_more": more})
    both = _without_clashes(F.array_sort(F.concat("_pii_base", "_pii_more")))
    found = F.when(F.size("_pii_more") == 0, F.array_sort("_pii_base")).otherwise(both)
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != into], found.alias(into))


def mask_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span by its kind in angle brackets; of overlapping spans the first names the mask.

    Null texts stay null; n_chars, if there, follows the text.
    """
    rows = find_pii(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")), "text", "_pii")

    def replaced(parts):
        def step(at, x):
            low = F.greatest(at, x["start"])
            mask = F.when(x["start"] >= at, F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise(F.lit(""))
            end = F.greatest(at, x["end"])
            return end, F.struct(F.concat(cut(parts, at, low - at), mask).alias("piece"), end.alias("at"))

        return running(F.col("_pii"), F.lit(0), step, "struct<piece:string,at:int>")

    rows = rows.withColumn("done", F.when(F.size("_pii") > 0, bind(blocks(F.col("text")), replaced)))
    tail = F.substring("text", F.element_at("done", -1)["at"] + 1, F.length("text"))
    masked = F.concat(F.array_join(F.transform("done", lambda d: d["piece"]), ""), tail)
    rows = rows.withColumn("text", F.when(F.col("done").isNotNull(), masked).otherwise(F.col("text")))
    changed = {text: F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
