"""Concerts and recordings out of work mentions' payloads."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.text import alnum_key, dedup_key, iso_date, name_uuid, participant_key

_PEOPLE = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("discipline", T.StringType()), T.StructField("role", T.StringType())]))
#: What a payload may hold, whatever its source.
PAYLOAD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("_kind", "_source", "concert_id", "concert_key", "programID", "date", "city", "venue", "location", "season", "event_type", "eventType", "url", "conductor", "record_key", "title", "release_date", "label", "catalogue_number", "format")]
    + [T.StructField("conductors", T.ArrayType(T.StringType())), T.StructField("soloists", _PEOPLE), T.StructField("ensembles", T.ArrayType(T.StringType())), T.StructField("artists", _PEOPLE)]
)
#: Which payload fields make a source's concert key.
CONCERT_KEYS = {
    "concertgebouw_archive": ("date", "city"), "nyphil": ("programID", "date"), "berlinphil": ("concert_id",), "rco": ("concert_id",),
    "wienerphil": ("concert_id",),
}
NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def payload(mentions: DataFrame) -> DataFrame:
    """mentions(id, source, raw) with p, the parsed payload; broken JSON gives nulls [JSN-01, JSN-02]."""
    return mentions.withColumn("p", F.from_json("raw", PAYLOAD))


def concert_key(source: Column, p: Column) -> Column:
    """The identity of the mention's concert, or null where a required field is missing [JSN-01]."""
    out = F.when(p["_kind"].isNull() | (p["_kind"] == "concert"), F.when(p["_source"] == "llm", p["concert_key"]))
    for name, fields in CONCERT_KEYS.items():
        parts = [iso_date(p[f]) if f == "date" else F.coalesce(p[f], F.lit("")) if f == "city" else p[f] for f in fields]
        known = parts[0].isNotNull() if "city" in fields else parts[0].isNotNull() & parts[-1].isNotNull()
        out = F.when(source == name, F.when(known, F.concat_ws("|", *parts))).otherwise(out)
    return out


def concerts(mentions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(concerts, participants, works) of mentions(id, source, raw) [AGG-16, ING-13, ING-14].

    A concert's own fields are those of its first mention; its people the union of all mentions, a soloist's
    discipline the first that is given; ids follow from source and key.
    """
    rows = payload(mentions)
    rows = rows.withColumn("key", concert_key(F.col("source"), F.col("p"))).filter("key IS NOT NULL")
    rows = rows.withColumn("concert_id", name_uuid(NAMESPACE, F.concat_ws("\0", F.lit("concert"), "source", "key")))
    p = F.col("p")
    own = F.struct(
        F.substring(iso_date(p["date"]), 1, 10).alias("date"), F.coalesce(p["venue"], p["location"], p["city"]).alias("venue"), p["season"].alias("season"),
        F.coalesce(p["event_type"], p["eventType"]).alias("event_type"), p["url"].alias("url"),
    )
    heads = rows.groupBy("concert_id", "source", "key").agg(F.min_by(own, "id").alias("o")).select("concert_id", "source", "key", "o.*")
    plain = lambda names, role: F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("discipline"), F.lit(role).alias("role")))
    none = F.array().cast("array<struct<name:string,discipline:string,role:string>>")
    leaders = F.array_compact(F.array_append(F.coalesce(p["conductors"], F.array().cast("array<string>")), p["conductor"]))
    people = F.concat(
        plain(leaders, "conductor"),
        F.coalesce(F.transform(p["soloists"], lambda s: F.struct(s["name"].alias("name"), s["discipline"].alias("discipline"), F.lit("soloist").alias("role"))), none),
        F.coalesce(plain(p["ensembles"], "ensemble"), none),
    )
    credits = rows.select("concert_id", "id", F.explode(people).alias("c")).select("concert_id", "id", "c.*").filter("name IS NOT NULL")
    credits = credits.groupBy("concert_id", "role", "name").agg(F.min_by("discipline", F.when(F.col("discipline").isNotNull(), F.col("id"))).alias("discipline"))
    return heads, credits, rows.select("concert_id", F.col("id").alias("mention")).distinct()


def linked_credits(credits: DataFrame, ensembles: DataFrame, persons: DataFrame, aliases: DataFrame) -> DataFrame:
    """credits with entity: an ensemble by ensemble, person, alias map; others by person, ensemble, alias [JON-07].

    The maps have columns (name, entity); a name that a map holds twice is matched to its least entity.
    """
    out = credits
    for label, df in (("_e", ensembles), ("_p", persons), ("_a", aliases)):
        out = out.join(df.groupBy("name").agg(F.min("entity").alias(label)), "name", "left")
    first = F.when(F.col("role") == "ensemble", F.coalesce("_e", "_p", "_a")).otherwise(F.coalesce("_p", "_e", "_a"))
    return out.withColumn("entity", first).drop("_e", "_p", "_a")


#: Roles that stay; any other is a performer's.
RECORDING_ROLES = ("conductor", "soloist", "ensemble")


def recordings(mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(releases, participants) of mentions with a recording payload, folded by (source, record_key) [AGG-17, JSN-02]."""
    rows = payload(mentions).filter("p._kind = 'recording' AND p.record_key IS NOT NULL")
    rows = rows.withColumn("key", F.col("p.record_key"))
    own = F.struct(*[F.col("p")[f].alias(f) for f in ("title", "release_date", "label", "catalogue_number", "format", "url")])
    heads = rows.groupBy("source", "key").agg(F.min_by(own, "id").alias("o"), F.array_sort(F.collect_set("id")).alias("mentions"))
    who = rows.select("source", "key", "id", F.posexplode("p.artists").alias("at", "c")).filter("c.name IS NOT NULL")
    role = F.when(F.lower("c.role").isin(*RECORDING_ROLES), F.lower("c.role")).otherwise("performer")
    who = who.select("source", "key", F.col("c.name").alias("name"), F.struct(role.alias("role"), F.col("c.discipline").alias("discipline")).alias("r"), F.struct("id", "at").alias("o"))
    who = who.groupBy("source", "key", "name").agg(F.min_by("r", "o").alias("r"), F.min("o").alias("place"))
    who = who.select("source", "key", "name", "r.*", "place")
    return heads.select("source", "key", "o.*", "mentions"), who


def recording_clusters(releases: DataFrame, participants: DataFrame) -> DataFrame:
    """(source, key, cluster): releases of one title that share a performer, unless catalogue numbers tell them apart [LNK-30].

    Only releases of equal source and title meet, each title in one task. A performer links the first release that lists
    them, by key, to their others, performers in the order of the releases that list them and of their credits; a link
    that would bring two catalogue numbers together is left out. Untitled releases stay alone.
    """
    credit = F.struct("place", participant_key(F.col("name")).alias("who"))
    people = participants.groupBy("source", "key").agg(F.array_sort(F.collect_list(credit))["who"].alias("people"))
    rows = releases.join(people, ["source", "key"], "left").select(
        "source", "key", dedup_key(F.coalesce("title", F.lit(""))).alias("block"), alnum_key(F.col("catalogue_number")).alias("number"), "people",
        F.coalesce("title", F.lit("")) != "",
    ).toDF("source", "key", "block", "number", "people", "titled")
    alone = rows.filter("NOT titled").select("source", "key", F.col("key").alias("cluster"))

    def merge(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("key")
        group = {r.key: ([r.key], {r.number} - {None, ""}) for r in block.itertuples()}
        by_person: dict[str, list[str]] = {}
        for r in block.itertuples():
            for who in r.people if r.people is not None else []:
                if who:
                    by_person.setdefault(who, []).append(r.key)
        for first, *others in by_person.values():
            for other in others:
                x, y = group[first], group[other]
                if x is y or len(x[1] | y[1]) > 1:
                    continue
                x[0].extend(y[0])
                x[1].update(y[1])
                for key in y[0]:
                    group[key] = x
        source = block.source.iloc[0]
        return pd.DataFrame([(source, k, min(g[0])) for k, g in group.items()], columns=["source", "key", "cluster"])

    many = rows.filter("titled").groupBy("source", "block").applyInPandas(merge, "source string, key string, cluster string")
    return alone.unionByName(many)


def merged_recordings(releases: DataFrame, clusters: DataFrame) -> DataFrame:
    """One release a cluster: each field's first value that is not empty, the fullest release first, then by key [AGG-18]."""
    fields = ["title", "release_date", "label", "catalogue_number", "format", "url"]
    full = sum((F.when(F.coalesce(F.col(f), F.lit("")) != "", 1).otherwise(0) for f in fields), F.lit(0))
    rows = releases.join(clusters, ["source", "key"])
    order = F.struct((-full).alias("n"), F.col("key").alias("k"))
    first = lambda f: F.min_by(f, F.when(F.coalesce(F.col(f), F.lit("")) != "", order)).alias(f)
    return rows.groupBy("source", "cluster").agg(*[first(f) for f in fields], F.array_sort(F.array_distinct(F.flatten(F.collect_list("mentions")))).alias("mentions"))
