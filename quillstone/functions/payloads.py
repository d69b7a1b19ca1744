"""What a work mention's payload says apart from its title. Payloads are JSON texts; broken ones say nothing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstone.functions.text import date_order, recording_code

#: Sources whose payload names the work's authority item, and the source with identifiers and codes.
ITEM_SOURCES = ("wikidata_works", "wikidata_catalogue", "wikidata_instrumentation")
CODE_SOURCE = "wikidata_catalogue"
_UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
_ISO = r"^-?\d{1,4}(-\d{2}(-\d{2})?)?$"


def _strings(raw: Column, path: str) -> Column:
    """The texts at a path, whether it holds one or a list of them; none where it holds anything else."""
    value = F.try_parse_json(raw)
    many = F.try_variant_get(value, path, "array<string>")
    one = F.try_variant_get(value, path, "string")
    listed = F.schema_of_variant(F.try_variant_get(value, path, "variant")).startswith("ARRAY")
    found = F.when(listed, many).otherwise(F.array(one))
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda x: F.coalesce(x != "", F.lit(False)))


def authority_id(value: Column) -> Column:
    """'Q42' of 'Q42' or of a URI that ends so; null for anything else."""
    return F.nullif(F.regexp_extract(value, r"(?:^|/)(Q\d+)$", 1), F.lit(""))


def premiere_of(raw: Column) -> Column:
    """struct<date, place> of a payload's world premiere; null without a date in ISO form [STR-20].

    The date is of any precision; a place that is no text, or blank, is null.
    """
    value = F.try_parse_json(raw)
    text = lambda path: F.when(F.schema_of_variant(F.try_variant_get(value, path, "variant")) == "STRING", F.trim(F.try_variant_get(value, path, "string")))
    date, place = text("$.premiere.date"), text("$.premiere.place")
    return F.when(date.rlike(_ISO), F.struct(date.alias("date"), F.nullif(place, F.lit("")).alias("place")))


def supersedes(new: Column, current: Column) -> Column:
    """Whether a premiere's date replaces another: none yet, earlier, or of finer precision [STR-20, ING-06]."""
    return new.isNotNull() & (current.isNull() | (date_order(new) < date_order(current)))


def external_ids(source: Column, raw: Column) -> Column:
    """array<string> 'scheme:value', sorted: authority items, work ids and codes that a payload states [JSN-03]."""
    none = F.array().cast("array<string>")
    value = F.try_parse_json(raw)
    item = authority_id(F.try_variant_get(value, "$.item", "string"))
    items = F.when(source.isin(*ITEM_SOURCES) & item.isNotNull(), F.array(F.concat(F.lit("wikidata:"), item))).otherwise(none)
    works = F.filter(F.transform(_strings(raw, "$.musicbrainz_work"), F.lower), lambda x: x.rlike(_UUID))
    codes = F.filter(F.transform(_strings(raw, "$.iswc"), recording_code), lambda x: x.isNotNull())
    both = F.concat(F.transform(works, lambda x: F.concat(F.lit("musicbrainz:"), x)), F.transform(codes, lambda x: F.concat(F.lit("iswc:"), x)))
    return F.array_sort(F.array_distinct(F.concat(items, F.when(source == CODE_SOURCE, both).otherwise(none))))


def part_of(source: Column, raw: Column) -> Column:
    """array<string>: authority items that the payload's work is part of, sorted [JSN-03]."""
    found = F.filter(F.transform(_strings(raw, "$.part_of"), authority_id), lambda x: x.isNotNull())
    return F.when(source == CODE_SOURCE, F.array_sort(F.array_distinct(found))).otherwise(F.array().cast("array<string>"))


def scoring_parts(raw: Column) -> Column:
    """array<struct<stated, instrument, count, solo>> of a payload's parts [JSN-04].

    A count is a whole number above 0, and a truth value is none; blank texts are null; an entry that is no object is left out.
    """
    value = F.try_parse_json(raw)
    parts = F.coalesce(F.try_variant_get(value, "$.instrumentation.parts", "array<variant>"), F.array().cast("array<variant>"))
    kind = lambda p, path: F.schema_of_variant(F.try_variant_get(p, path, "variant"))
    text = lambda p, path: F.when(kind(p, path) == "STRING", F.nullif(F.try_variant_get(p, path, "string"), F.lit("")))

    def part(p: Column) -> Column:
        n = F.when(kind(p, "$.count") == "BIGINT", F.try_variant_get(p, "$.count", "bigint"))
        solo = F.when(kind(p, "$.solo") == "BOOLEAN", F.try_variant_get(p, "$.solo", "boolean"))
        return F.struct(
            F.coalesce(text(p, "$.stated"), text(p, "$.label")).alias("stated"), text(p, "$.instrument").alias("instrument"),
            F.when(n > 0, n).alias("count"), F.coalesce(solo, F.lit(False)).alias("solo"),
        )

    return F.transform(F.filter(parts, lambda p: F.schema_of_variant(p).startswith("OBJECT")), part)
