"""Points bare names at the entities that an authority id pins: ensembles, places, genres. Survey ids in brackets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import dedup_key
from quillstone.operators.relational import two_tier_match, unique_match

#: Leading articles, and spellings of one ensemble word.
ARTICLES = ("the", "der", "die", "das", "les", "le", "la", "het", "de", "il")
ENSEMBLE_WORDS = {
    "philharmoniker": "philharmonic",
    "orchester": "orchestra",
    "orchestre": "orchestra",
    "orkest": "orchestra",
}
LONG_PHRASE, SHORT_PHRASE = "philharmonic orchestra", "philharmonic"
#: Fixed value: names of a part of an ensemble; the group is the whole.
SUBSET = r"^(?:the )?(?:members of|mitglieder (?:der|des)) (?:the |der |des )?(.+)$"


def ensemble_key(name: Column) -> Column:
    """dedup_key without a leading article, ensemble words in one spelling [STR-07]. A lone article stays."""
    words = F.split(dedup_key(name), " ")
    headed = (F.size(words) > 1) & F.get(words, F.lit(0)).isin(*ARTICLES)
    words = F.when(headed, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1)))).otherwise(words)
    table = F.create_map(*[F.lit(x) for pair in ENSEMBLE_WORDS.items() for x in pair])
    key = F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w)), " ")
    return F.regexp_replace(key, rf"\b{LONG_PHRASE}\b", SHORT_PHRASE)


def whole_of(name: Column) -> Column:
    """The ensemble that a name is a part of ('Members of the ...'), or null [STR-07]."""
    return F.nullif(F.regexp_extract(dedup_key(name), SUBSET, 1), F.lit(""))


def anchor_names(ensembles: DataFrame, aliases: DataFrame) -> DataFrame:
    """(k, target): keys of the pinned ensembles' labels and aliases, each pair once.

    ensembles(id, label, qid), aliases(id, value)
    """
    pinned = ensembles.filter("qid IS NOT NULL")
    names = pinned.select("id", F.col("label").alias("name"))
    names = names.unionByName(aliases.select("id", F.col("value").alias("name")).join(pinned.select("id"), "id", "left_semi"))
    return names.filter("name IS NOT NULL").select(ensemble_key(F.col("name")).alias("k"), F.col("id").alias("target")).distinct()


def anchored(ensembles: DataFrame, aliases: DataFrame, cities: DataFrame) -> DataFrame:
    """(id, canonical, outcome) of ensembles without an id: anchored, ambiguous, unanchored or member_of [LNK-33, JON-08].

    A key of one anchor decides; of several, the one whose home city the name spells out, if exactly one does. Parts
    of an ensemble stay themselves. cities(id, city): where anchors are based.
    """
    names = anchor_names(ensembles, aliases)
    bare = ensembles.filter("qid IS NULL").select("id", "label", ensemble_key(F.col("label")).alias("k"), whole_of(F.col("label")).isNotNull().alias("part"))
    held = names.groupBy("k").agg(F.min("target").alias("_one"), F.count("*").alias("_n"))
    rows = bare.join(held, "k", "left")
    home = names.join(cities.select(F.col("id").alias("target"), dedup_key(F.col("city")).alias("city")), "target")
    told = F.contains(F.concat(F.lit(" "), dedup_key(F.col("label")), F.lit(" ")), F.concat(F.lit(" "), F.col("city"), F.lit(" ")))
    named = rows.filter("_n > 1 AND NOT part").select("id", "label", "k").join(home, "k").filter(told)
    named = named.groupBy("id").agg(F.min("target").alias("_city"), F.max("target").alias("_other"))
    rows = rows.join(named, "id", "left")
    target = F.when(F.col("_n") == 1, F.col("_one")).when(F.col("_city") == F.col("_other"), F.col("_city"))
    outcome = F.when(F.col("part"), "member_of").when(target.isNotNull(), "anchored").when(F.col("_n") > 1, "ambiguous").otherwise("unanchored")
    return rows.select("id", F.when(~F.col("part"), target).alias("canonical"), outcome.alias("outcome"))


def anchor_report(ensembles: DataFrame, persons: DataFrame, aliases: DataFrame, cities: DataFrame, credited: DataFrame) -> DataFrame:
    """One row of counts: anchors, each outcome, unanchored ones that are credited, and names that cross kinds [LNK-33, LNK-35].

    persons(id, label, qid), credited(id)
    """
    rows = anchored(ensembles, aliases, cities).join(credited.select("id", F.lit(True).alias("seen")).distinct(), "id", "left")
    is_ = lambda x: F.col("outcome") == x
    counts = rows.agg(
        F.count_if(is_("anchored")).alias("anchored"), F.count_if(is_("ambiguous")).alias("ambiguous"),
        F.count_if(is_("unanchored")).alias("unanchored"), F.count_if(is_("unanchored") & F.col("seen")).alias("unanchored_credited"),
        F.count_if(is_("member_of")).alias("members_of"),
    )
    keys = anchor_names(ensembles, aliases).select("k").distinct()
    crossing = persons.withColumn("k", ensemble_key(F.col("label"))).join(keys, "k", "left_semi").agg(F.count("*").alias("persons_like_anchors"))
    names = persons.filter("qid IS NOT NULL").select(dedup_key(F.col("label")).alias("k")).distinct()
    back = ensembles.filter("qid IS NULL").withColumn("k", dedup_key(F.col("label"))).join(names, "k", "left_semi")
    back = back.agg(F.count("*").alias("ensembles_like_persons"))
    anchors = ensembles.agg(F.count("qid").alias("anchors"))
    one = lambda df: df.withColumn("_row", F.lit(1))
    out = one(anchors)
    for part in (counts, crossing, back):
        out = out.join(one(part), "_row")
    return out.drop("_row")


def linked_places(places: DataFrame) -> DataFrame:
    """(id, canonical) of places(id, label, qid): a bare one goes to the only pinned one of its name [LNK-31]."""
    keyed = places.withColumn("k", dedup_key(F.col("label")))
    targets = keyed.filter("qid IS NOT NULL").select("k", F.col("id").alias("canonical"))
    return unique_match(keyed.filter("qid IS NULL").select("id", "k"), targets, "k", "canonical").select("id", "canonical")


def linked_genres(genres: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, canonical) of genres(id, label, qid): by label, and by aliases(id, value) of pinned ones where no label fits [LNK-32]."""
    keyed = genres.withColumn("k", dedup_key(F.col("label")))
    pinned = keyed.filter("qid IS NOT NULL")
    labels = pinned.select("k", F.col("id").alias("canonical"))
    others = aliases.join(pinned.select("id"), "id", "left_semi").select(dedup_key(F.col("value")).alias("k"), F.col("id").alias("canonical"))
    return two_tier_match(keyed.filter("qid IS NULL").select("id", "k"), labels, others, "k", "canonical").select("id", "canonical")
