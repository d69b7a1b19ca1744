"""What a work's title says: opus, number, key, catalogue numbers, kind [STR-10..15, STR-34]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Catalogue schemes by the letters that introduce them, and whose they are (null: anyone's).
SCHEMES = (
    ("bwv", "BWV", "bach"), ("kv", "KV|K", "mozart"), ("hob", "Hob", "haydn"), ("rv", "RV", "vivaldi"), ("hwv", "HWV", "handel"),
    ("d", "D", "schubert"), ("woo", "WoO", None), ("s", "S", "liszt"), ("sz", "Sz", "bartok"), ("twv", "TWV", "telemann"),
)
#: Kinds of work that a title names.
WORK_TYPES = (
    "symphony", "sonata", "concerto", "quartet", "quintet", "trio", "mass", "requiem", "overture", "suite", "cantata", "prelude",
    "fugue", "nocturne", "waltz", "opera", "ballet", "serenade", "variations", "rhapsody", "partita", "etude", "mazurka",
)
#: German pitch names by the English ones.
GERMAN_PITCH = {"h": "b", "b": "b flat", "cis": "c sharp", "dis": "d sharp", "fis": "f sharp", "gis": "g sharp", "as": "a flat", "es": "e flat", "des": "d flat", "ges": "g flat"}
_NUMBER = r"(\d+[a-z]?)"


def _found(title: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(title, pattern, group), F.lit(""))


def opus(title: Column) -> Column:
    return F.lower(_found(title, r"(?i)\bop(?:us)?\.?\s*" + _NUMBER))


def number_in_opus(title: Column) -> Column:
    """The number after the opus, or else the one of 'No. 5'."""
    after = _found(title, r"(?i)\bop(?:us)?\.?\s*\d+[a-z]?\s*[,/]?\s*(?:no|nr)\.?\s*(\d+)")
    return F.coalesce(after, _found(title, r"(?i)\b(?:no|nr|n°)\.?\s*(\d+)")).cast("int")


def musical_key(title: Column) -> Column:
    """'c sharp minor' of 'C-sharp minor' or 'cis-Moll'; null for other spellings [STR-11]."""
    english = F.lower(F.concat_ws(" ", _found(title, r"(?i)\bin\s+([A-G])\b[- ]?(?:sharp|flat)?[- ]?(?:major|minor)"), _found(title, r"(?i)\bin\s+[A-G][- ]?(sharp|flat)[- ]?(?:major|minor)"), _found(title, r"(?i)\bin\s+[A-G][- ]?(?:sharp|flat)?[- ]?(major|minor)")))
    pitch, mode = F.lower(_found(title, r"(?i)\b([A-H](?:is|es|s)?)[- ](?:dur|moll)\b")), F.lower(_found(title, r"(?i)\b[A-H](?:is|es|s)?[- ](dur|moll)\b"))
    names = F.create_map(*[F.lit(x) for pair in GERMAN_PITCH.items() for x in pair])
    plain = F.when(F.length(pitch) == 1, pitch)
    german = F.concat_ws(" ", F.coalesce(F.try_element_at(names, pitch), plain), F.when(mode == "dur", "major").otherwise("minor"))
    known = F.coalesce(F.try_element_at(names, pitch), plain).isNotNull()
    return F.when(F.length(english) > 2, english).when(mode.isNotNull() & known, german)


def work_type(title: Column) -> Column:
    words = F.split(F.lower(title), r"[^\p{L}]+")
    out = F.lit(None).cast("string")
    for kind in reversed(WORK_TYPES):
        out = F.when(F.array_contains(words, kind), kind).otherwise(out)
    return out


def catalogue_ids(title: Column, surname: Column) -> Column:
    """array<string> 'scheme:number' of the schemes that are the composer's, or anyone's, sorted [STR-12, STR-15]."""
    found = []
    for scheme, letters, owner in SCHEMES:
        number = F.lower(_found(title, rf"\b(?:{letters})\.?\s*(?:Nr\.?\s*)?" + r"([IVX]+[:/]\d+[a-z]?|\d+[a-z]?)\b"))
        allowed = F.lit(True) if owner is None else surname == owner
        found.append(F.when(number.isNotNull() & allowed, F.concat(F.lit(f"{scheme}:"), number)))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))


def derivation(title: Column) -> Column:
    """'arrangement' or 'excerpt' where the title says that it is no work of its own."""
    return F.when(title.rlike(r"(?i)\b(arr\.|arranged|transcri\w+)"), "arrangement").when(title.rlike(r"(?i)\b(excerpts?|aria from|suite from)\b"), "excerpt")


def core_title(key: Column) -> Column:
    """A title key without opus, catalogue and key words."""
    letters = "|".join(s[1] for s in SCHEMES).lower()
    out = F.regexp_replace(key, rf"\b(?:op(?:us)?|no|nr|{letters})\s*\d+[a-z]?\b|\bin\s+[a-g](?:\s+(?:sharp|flat))?\s+(?:major|minor)\b", " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


#: Schemes whose numbers start anew with every composer, external ids, and the scheme of opus numbers.
PER_COMPOSER = ("woo", "anh")
EXTERNAL_SCHEMES = ("wikidata", "musicbrainz", "iswc")
OPUS = "op"


def _scheme(i: Column) -> Column:
    return F.split_part(i, F.lit(":"), F.lit(1))


def holds_sets(scheme: Column) -> Column:
    """Whether hyphens and commas in a scheme's values part numbers: ids of other kinds have hyphens of their own [STR-33]."""
    return scheme.isin(*[s[0] for s in SCHEMES])


def is_composer_scoped(scheme: Column) -> Column:
    """Whether a number of the scheme says whose the work is [STR-33]."""
    return holds_sets(scheme) & ~scheme.isin(*PER_COMPOSER)


def has_catalogue(ids: Column) -> Column:
    """Whether any of 'scheme:value' ids is a catalogue number: neither an external id nor an opus [STR-33]."""
    return F.exists(ids, lambda i: ~_scheme(i).isin(*EXTERNAL_SCHEMES, OPUS))


#: The scheme of catalogues that are items of their own.
ITEM_SCHEMES = {"Q162478": "kv", "Q22338962": "kv", "Q66069477": "kv", "Q22340538": "kv", "Q214203": "bwv", "Q847730": "hwv", "Q164058": "twv", "Q739093": "hob"}


def item_code(code: Column, item: Column, short: Column, surname: Column) -> Column:
    """array<string> 'scheme:value' of a stated code, given its catalogue's item and that item's short name [STR-14].

    A known item decides the scheme, with or without the letters before the number; else the code is read as a title
    is, after the short name if it starts with a number; else a code with a digit is a number of the item's own scheme.
    """
    plain = F.trim(F.regexp_replace(code, r"\s+", " "))
    known = F.try_element_at(F.create_map(*[F.lit(x) for pair in ITEM_SCHEMES.items() for x in pair]), item)
    number = F.lower(_found(plain, r"^(?:[A-Za-zöÖ.]+\s*)?([IVX]+[:/]\d+[a-z]?|\d+[a-z]?(?:/\d+[a-z]?)?)$"))
    numbered = F.when(plain.rlike(r"^[\dIVXLC]") & short.isNotNull(), F.concat_ws(" ", short, plain)).otherwise(plain)
    read = catalogue_ids(numbered, surname)
    folded = F.trim(F.regexp_replace(F.lower(plain), r"[\s,\-–—]+", " "))
    own = F.when(item.isNotNull() & plain.rlike(r"\d"), F.array(F.concat(F.lit("wd:"), item, F.lit(":"), folded)))
    return (
        F.when(known.isNotNull() & number.isNotNull(), F.array(F.concat(known, F.lit(":"), number))).when(F.size(read) > 0, read)
        .otherwise(F.coalesce(own, F.array().cast("array<string>")))
    )
