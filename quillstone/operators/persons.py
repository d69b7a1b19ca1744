"""One record a person out of claims [LNK-01]."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import first_year, pinned_id
from quillstone.operators.relational import consensus


def person_records(entities: DataFrame, claims: DataFrame) -> DataFrame:
    """(id, label, aliases, birth, death, birth_years, death_years, birth_sources, death_sources, musicbrainz, qid, sources).

    entities(id, label, dedup_key), claims(subject, predicate, value, source). A source's year is its claims' latest in
    value order; birth and death are the year that most sources name, ties to the earliest. Sets are sorted; persons
    without claims have empty ones.
    """
    said = claims.filter("value IS NOT NULL AND value <> ''")
    dates = said.filter(F.col("predicate").isin("born_on", "died_on"))
    dates = dates.withColumn("year", first_year(F.col("value"))).filter("year IS NOT NULL")
    dates = dates.groupBy("subject", "predicate", "source").agg(F.max("year").alias("year"))
    agreed = consensus(dates, ["subject", "predicate"], "year")
    kept = lambda test, column, name: F.array_sort(F.collect_set(F.when(test, column))).alias(name)
    born, died = F.col("predicate") == "born_on", F.col("predicate") == "died_on"
    years = dates.groupBy("subject").agg(
        kept(born, F.col("year"), "birth_years"), kept(died, F.col("year"), "death_years"),
        kept(born, F.col("source"), "birth_sources"), kept(died, F.col("source"), "death_sources"),
    )
    when = agreed.groupBy("subject").agg(F.max(F.when(born, F.col("year"))).alias("birth"), F.max(F.when(died, F.col("year"))).alias("death"))
    sets = claims.groupBy("subject").agg(
        kept((F.col("predicate") == "also_known_as") & (F.col("value") != ""), F.col("value"), "aliases"),
        kept((F.col("predicate") == "musicbrainz_id") & (F.col("value") != ""), F.trim("value"), "musicbrainz"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    )
    out = entities.select("id", "label", pinned_id(F.col("dedup_key")).alias("qid"))
    for part in (when, years, sets):
        out = out.join(part.withColumnRenamed("subject", "id"), "id", "left")
    empty = {"aliases": "string", "birth_years": "int", "death_years": "int", "musicbrainz": "string"}
    fill = {c: F.coalesce(c, F.array().cast(f"array<{t}>")) for c, t in empty.items()}
    names = claims.schema["source"].dataType.simpleString()
    fill |= {c: F.coalesce(c, F.array().cast(f"array<{names}>")) for c in ("birth_sources", "death_sources", "sources")}
    return out.withColumns(fill)
