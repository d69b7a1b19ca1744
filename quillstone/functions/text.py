"""Scalar text functions as Spark columns. Only Unicode folding needs Python; it runs batch-wise over Arrow."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed value: keys are cut to this many characters.
KEY_CHARS = 512


@F.pandas_udf(StringType())
def fold(values: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks; null stays null."""

    def one(x: str | None) -> str | None:
        if x is None or x.isascii():
            return x
        return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))

    return values.map(one)


def _key(text: Column, punctuation: str) -> Column:
    plain = F.regexp_replace(F.lower(fold(text)), r"[^\p{L}\p{N}_\s]", punctuation)
    return F.substring(F.trim(F.regexp_replace(plain, r"\s+", " ")), 1, KEY_CHARS)


def straight_name(name: Column) -> Column:
    """'Last, First' as 'First Last', cut at the first comma."""
    name = F.trim(name)
    at = F.locate(",", name)
    turned = F.trim(F.concat_ws(" ", F.trim(F.substring(name, at + 1, F.length(name))), F.trim(F.substring(name, F.lit(1), at - 1))))
    return F.when(at > 0, turned).otherwise(name)


def dedup_key(name: Column, qid: Column | None = None) -> Column:
    """Identity of a name: straightened, folded, lower case, punctuation deleted [STR-01]. A pinned id is appended."""
    key = _key(straight_name(name), "")
    return key if qid is None else F.when(qid.isNotNull(), F.concat_ws("|", key, qid)).otherwise(key)


#: Kinds whose key is the external id alone, where there is one.
ID_KEYED_KINDS = ("genre", "movement", "ensemble", "venue")


def entity_key(kind: Column, name: Column, qid: Column) -> Column:
    by_id = kind.isin(*ID_KEYED_KINDS) & qid.isNotNull()
    return F.when(by_id, F.concat(F.lit("wikidata:"), qid)).otherwise(dedup_key(name, qid))


def pinned_id(key: Column) -> Column:
    """The external id in a key, or null [STR-01, STR-32]."""
    found = F.regexp_extract(key, r"^wikidata:(Q\d+)$|\|(Q\d+)$", 0)
    return F.nullif(F.regexp_extract(found, r"(Q\d+)$", 1), F.lit(""))


def id_of_url(url: Column) -> Column:
    """The external id of an authority's own page URL, or null [STR-32]."""
    return F.nullif(F.regexp_extract(url, r"wikidata\.org/(?:wiki|entity)/(Q\d+)", 1), F.lit(""))


def title_key(title: Column) -> Column:
    """As dedup_key, but punctuation parts words [STR-02]."""
    return _key(title, " ")


def name_uuid(namespace_hex: str, name: Column) -> Column:
    """RFC 4122 version 5 UUID of a name: SHA-1 with version and variant bits set [STR-31]."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(
        part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12)
    )


def content_hash(*parts: Column) -> Column:
    """SHA-256 of the parts joined by NUL; null counts as empty [STR-29]."""
    return F.sha2(F.concat_ws("\0", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def iso_date(text: Column) -> Column:
    """DD-MM-YYYY as YYYY-MM-DD; anything else as it is [STR-21]."""
    return F.regexp_replace(text, r"^(\d{2})-(\d{2})-(\d{4})$", "$3-$2-$1")


def first_year(text: Column) -> Column:
    """The first four digits in a row, as a number [STR-24]."""
    return F.nullif(F.regexp_extract(text, r"\d{4}", 0), F.lit("")).cast("int")


def date_order(text: Column) -> Column:
    """Sort key of a date of any precision: earlier first, and a finer date before its own prefix [STR-19]."""
    got = lambda k: F.nullif(F.regexp_extract(text, r"^(-?\d{1,4})(?:-(\d{2}))?(?:-(\d{2}))?", k), F.lit("")).cast("int")
    return F.struct(got(1).alias("year"), F.coalesce(got(2), F.lit(99)).alias("month"), F.coalesce(got(3), F.lit(99)).alias("day"))


def truncate_time(text: Column, precision: Column) -> Column:
    """A timestamp text cut to its precision: 11 day, 10 month, 9 and less year; else the day [STR-23]."""
    day = F.regexp_extract(text, r"^\+?(-?\d+-\d{2}-\d{2})", 1)
    size = F.when(precision == 10, 3).when(precision <= 9, 6).otherwise(0)
    return F.nullif(F.substring(day, F.lit(1), F.length(day) - size), F.lit(""))


#: Fixed values.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def long_date(text: Column) -> Column:
    """'7 May 1824', 'May 1824' or '1824' as ISO of the same precision; null otherwise [STR-22]."""
    pattern = r"^\s*(?:(\d{1,2})\s+)?(?:([A-Za-z]+)\s+)?(\d{4})\s*$"
    day, month, year = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(month))
    full = F.concat_ws("-", year, F.lpad(number.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    to_month = F.concat_ws("-", year, F.lpad(number.cast("string"), 2, "0"))
    named = (month != "") & (number > 0)
    return (
        F.when(year == "", None).when((month == "") & (day == ""), year).when(named & (day == ""), to_month).when(named, full)
    )


def minutes(text: Column) -> Column:
    """Minutes of a duration text; of a range the lower bound; hours count [STR-25]."""
    number = lambda p: F.nullif(F.regexp_extract(F.lower(text), p, 1), F.lit("")).cast("int")
    hours, mins = number(r"(\d+)\s*(?:h|hours?)\b"), number(r"(\d+)(?:\s*[-–]\s*\d+)?\s*(?:'|m|min|mins|minutes?)(?:\b|\s|$)")
    return F.when(hours.isNotNull() | mins.isNotNull(), F.coalesce(hours, F.lit(0)) * 60 + F.coalesce(mins, F.lit(0)))


def recording_code(text: Column) -> Column:
    """T-123.456.789-0 of any spelling as T1234567890; null if it is none [STR-26]."""
    bare = F.upper(F.regexp_replace(text, r"[^A-Za-z0-9]", ""))
    return F.when(bare.rlike(r"^T\d{10}$"), bare)


def is_language_tag(text: Column) -> Column:
    """Language, optional script, region and variants, as BCP 47 writes them [STR-27]."""
    return text.rlike(r"^[A-Za-z]{2,3}(-[A-Za-z]{4})?(-([A-Za-z]{2}|\d{3}))?(-([A-Za-z0-9]{5,8}|\d[A-Za-z0-9]{3}))*$")


def roman_value(text: Column) -> Column:
    """Value of a roman number up to C; null for anything else [STR-16]."""
    canonical = text.rlike(r"^(?=[CLXVI])(C|XC|L?X{0,3}|XL)(IX|IV|V?I{0,3})$")
    sign = F.create_map(*[F.lit(x) for pair in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100)) for x in pair])
    values = F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(sign, c), F.lit(0)))
    signed = F.transform(values, lambda v, i: F.when(v < F.coalesce(F.get(values, i + 1), F.lit(0)), -v).otherwise(v))
    return F.when(canonical, F.aggregate(signed, F.lit(0), lambda a, v: a + v))


def plain_text(html: Column) -> Column:
    """HTML without comments, scripts, styles and tags, its commonest entities resolved, white space collapsed [STR-28]."""
    out = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def catalogue_members(code: Column, most: int = 500) -> Column:
    """Numbers of a catalogue list such as '3, 5-7'; a range wider than `most` stands for itself [STR-13]."""

    def member(x: Column) -> Column:
        low, high = F.regexp_extract(x, r"^(\d+)-(\d+)$", 1).try_cast("int"), F.regexp_extract(x, r"^(\d+)-(\d+)$", 2).try_cast("int")
        wide = (high >= low) & (high - low < most)
        return F.when(wide, F.transform(F.sequence(low, F.when(wide, high).otherwise(low)), lambda n: n.cast("string"))).otherwise(F.array(x))

    parts = F.filter(F.transform(F.split(code, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.flatten(F.transform(parts, member))


#: Courtesy titles that do not tell performers apart.
HONORIFICS = ("sir", "dame", "dr", "prof", "maestro", "lord", "lady")


def participant_key(name: Column) -> Column:
    """dedup_key without leading honorifics, however many [STR-08]."""
    return F.trim(F.regexp_replace(dedup_key(name), rf"^(?:(?:{'|'.join(HONORIFICS)})(?:\s+|$))+", ""))


def alnum_key(text: Column) -> Column:
    """Letters and digits, lower case [STR-08]."""
    return F.lower(F.regexp_replace(text, r"[^A-Za-z0-9]", ""))


#: Words that name a group of players or singers, in order of precedence.
ENSEMBLE_WORDS = (
    ("chamber", ("quartet", "trio", "quintet", "consort")),
    ("choir", ("choir", "chorus", "chor", "singers")),
    ("orchestra", ("orchestra", "philharmonic", "symphony", "sinfonietta")),
    ("opera", ("opera",)),
    ("band", ("band", "ensemble")),
)


def ensemble_type(name: Column) -> Column:
    """The first type one of whose words the name holds; null for a person's name [STR-09]."""
    words = F.split(F.lower(name), r"[^\p{L}]+")
    out = F.lit(None).cast("string")
    for kind, cues in reversed(ENSEMBLE_WORDS):
        out = F.when(F.arrays_overlap(words, F.array(*[F.lit(c) for c in cues])), kind).otherwise(out)
    return out


def tokens(name: Column) -> Column:
    """Folded words; one or two letters together are initials and come apart [STR-36]."""
    words = F.filter(F.split(F.lower(fold(name)), r"[^\p{L}]+"), lambda w: w != "")
    apart = lambda w: F.when(F.length(w) <= 2, F.filter(F.split(w, ""), lambda c: c != "")).otherwise(F.array(w))
    return F.flatten(F.transform(words, apart))


def distinct_spellings(values: Column) -> Column:
    """Values distinct but for case; the first spelling stays, in order [AGG-14, ARR-01]."""
    values = F.array_distinct(values)
    lower = F.transform(values, F.lower)
    return F.filter(values, lambda x, i: F.array_position(lower, F.lower(x)) == i + 1)


def log_odds(p: Column) -> Column:
    """Base 2, with p kept 1e-12 off 0 and 1 [MTH-01]."""
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), p))
    return F.log2(p / (1 - p))


def probability(bits: Column) -> Column:
    """Inverse of log_odds; certain beyond 64 bits either way [MTH-01]."""
    return F.when(bits >= 64, 1.0).when(bits <= -64, 0.0).otherwise(1 / (1 + F.pow(F.lit(2.0), -bits)))


def rarity_bits(reference: Column, frequency: Column) -> Column:
    """log2(reference / frequency) between -6 and 6; 0 where the value was never seen [MTH-02]."""
    bits = F.greatest(F.lit(-6.0), F.least(F.lit(6.0), F.log2(reference / frequency)))
    return F.when(frequency > 0, bits).otherwise(0.0)


def quarter_bits(bits: Column) -> Column:
    """To the nearest quarter, halves to even [MTH-05]."""
    return F.bround(bits / 0.25) * 0.25


def affinity(weight: Column, reach: Column) -> Column:
    """Weight over the root of the reach [MTH-03]."""
    return weight / F.sqrt(F.greatest(reach, F.lit(1)))


def cosine(shared: Column, a: Column, b: Column) -> Column:
    """[MTH-04]"""
    return F.try_divide(shared, F.sqrt(a * b))


def year_level(a: Column, b: Column) -> Column:
    """Agreement of two years: 0 equal, 1 to two apart, 2 to ten, 3 beyond; null if one is missing [STR-06]."""
    d = F.abs(a - b)
    return F.when(d == 0, 0).when(d <= 2, 1).when(d <= 10, 2).when(d > 10, 3)
