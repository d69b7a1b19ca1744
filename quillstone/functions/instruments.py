"""Instrumentation texts and orchestra shorthand [STR-17, STR-18]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Categories by the phrases that name them.
CATEGORIES = (
    ("orchestra", ("orchestra", "symphony orchestra", "full orchestra")),
    ("strings", ("strings", "string orchestra", "str")),
    ("string quartet", ("string quartet",)),
    ("piano", ("piano", "pianoforte", "klavier")),
    ("violin", ("violin", "violine", "vn")),
    ("cello", ("cello", "violoncello", "vc")),
    ("flute", ("flute", "fl")),
    ("choir", ("choir", "chorus", "mixed choir", "satb")),
    ("soprano", ("soprano",)),
    ("organ", ("organ",)),
)
WINDS = ("flute", "oboe", "clarinet", "bassoon")
BRASS = ("horn", "trumpet", "trombone", "tuba")


def category(phrase: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, phrases in CATEGORIES:
        out = F.when(F.lower(F.trim(phrase)).isin(*phrases), name).otherwise(out)
    return out


def instrumentation(text: Column) -> Column:
    """Categories of a whole phrase, or of 'x and y' if every part is known; commas part nothing; else none [STR-17]."""
    whole = category(text)
    parts = F.transform(F.split(F.lower(text), r"\s+(?:and|&|und|et)\s+"), lambda p: category(p))
    every = F.when(F.forall(parts, lambda p: p.isNotNull()), F.array_distinct(parts))
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.coalesce(every, F.array().cast("array<string>")))


def shorthand(text: Column) -> Column:
    """map<string, int> of '3.2.2.3 - 4.3.3.1 - timp - str'; null unless a section of four counts and strings are there [STR-18]."""
    parts = F.transform(F.split(F.lower(text), r"\s+[-–—]\s+"), lambda p: F.trim(p))
    counted = F.filter(parts, lambda p: p.rlike(r"^\d+(\.\d+){3}$"))
    strings = F.exists(parts, lambda p: p.rlike(r"^(str|strings|streicher)\.?$"))
    count = lambda k, i: F.try_element_at(F.split(F.get(counted, F.lit(k)), r"\."), F.lit(i + 1)).cast("int")
    entries = [F.struct(F.lit(n).alias("key"), count(0, i).alias("value")) for i, n in enumerate(WINDS)]
    entries += [F.struct(F.lit(n).alias("key"), count(1, i).alias("value")) for i, n in enumerate(BRASS)]
    extra = lambda name, pattern: F.struct(F.lit(name).alias("key"), F.when(F.exists(parts, lambda p: p.rlike(pattern)), 1).alias("value"))
    entries += [extra("timpani", r"^timp"), extra("percussion", r"^perc"), extra("harp", r"^(\d+ )?h(ar)?p"), extra("strings", r"^str")]
    found = F.filter(F.array(*entries), lambda e: e["value"] > 0)
    return F.when((F.size(counted) > 0) & strings, F.map_from_entries(found))
