"""The curated tables as a property graph, and as a blueprint of elements and connections. Survey ids in brackets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import distinct_spellings
from quillstone.operators.relational import values_by_count

#: The labels of entity kinds; other kinds are no vertices.
KIND_LABELS = {
    "person": "Person",
    "ensemble": "Ensemble",
    "venue": "Venue",
    "place": "Place",
    "genre": "Genre",
    "movement": "Movement",
    "profession": "Profession",
    "period": "Period",
}
#: Claims that become edges, typed by their names in capitals.
EDGE_PREDICATES = (
    "born_in", "died_in", "citizen_of", "has_genre", "in_movement", "has_profession", "associated_period", "subclass_of", "student_of",
    "teacher_of", "influenced_by", "child_of", "parent_of", "spouse_of", "sibling_of", "based_in", "part_of",
)
#: Literal claims on vertices, by how many values they keep and of which type.
SINGLE = ("born_on", "died_on", "first_season", "last_season", "musicbrainz_id", "ensemble_type")
COUNTS = ("sitelink_count", "work_count", "program_count")
LISTS = ("also_known_as", "performs_as", "has_function")
#: Names of literal claims on the map, and types that a kind has there besides KIND_LABELS.
MAP_FIELDS = {
    "born_on": "Born",
    "died_on": "Died",
    "program_count": "Programs",
    "first_season": "First season",
    "last_season": "Last season",
    "work_count": "Works (Wikidata)",
    "sitelink_count": "Wikipedia sitelinks",
}
MAP_LISTS = {"performs_as": "Instruments", "has_function": "Functions"}
MAP_KINDS = {"work": "Work", "event": "Event"}
ROLE_ORDER = ("composer", "conductor", "soloist", "performer", "ensemble")


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair]), key)


def properties(columns: dict[str, Column]) -> Column:
    """JSON text of the properties that are neither null nor an empty list [PRJ-05]."""
    full = {k: F.when(F.size(c) > 0, c) if k in LISTS or k in ("sources", "identifiers") else c for k, c in columns.items()}
    return F.to_json(F.struct(*[c.alias(k) for k, c in full.items()]), {"ignoreNullFields": "true"})


def literals(claims: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
    """(subject, <predicate>...): values of each wanted predicate, the most frequent first [AGG-12]; one row a subject."""
    rows = claims.filter(F.col("predicate").isin(*wanted) & F.col("value").isNotNull())
    ranked = values_by_count(rows, ["subject", "predicate"], "value")
    one = lambda p: F.max(F.when(F.col("predicate") == p, F.col("values"))).alias(p)
    return ranked.groupBy("subject").agg(*[one(p) for p in wanted])


def provenance(records: DataFrame) -> DataFrame:
    """(id, sources, url) of records(id, source, url): sorted names, and the url of the first source that has one [AGG-13]."""
    first = F.min(F.when(F.col("url").isNotNull(), F.struct("source", "url")))
    return records.groupBy("id").agg(F.array_sort(F.collect_set("source")).alias("sources"), first["url"].alias("url"))


def entity_vertices(entities: DataFrame, claims: DataFrame, records: DataFrame) -> DataFrame:
    """(label, id, properties) of entities(id, kind, label, qid); claims(subject, predicate, value) [GRF-01].

    Counts that are no numbers are left out; lists drop spellings that differ in case alone.
    """
    rows = entities.withColumn("_label", _lookup(KIND_LABELS, F.col("kind"))).filter("_label IS NOT NULL")
    rows = rows.join(literals(claims, SINGLE + COUNTS + LISTS).withColumnRenamed("subject", "id"), "id", "left")
    rows = rows.join(provenance(records), "id", "left")
    top = {p: F.get(F.col(p), F.lit(0)) for p in SINGLE + COUNTS}
    kept = {"label": F.col("label"), "wikidata_id": F.col("qid"), "sources": F.col("sources"), "url": F.col("url")}
    kept |= {p: top[p] for p in SINGLE}
    kept |= {p: F.when(top[p].rlike("^[0-9]+$"), top[p].try_cast("bigint")) for p in COUNTS}
    kept |= {p: distinct_spellings(F.col(p)) for p in LISTS}
    return rows.select(F.col("_label").alias("label"), F.col("id").cast("string").alias("id"), properties(kept).alias("properties"))


def work_vertices(works: DataFrame, identifiers: DataFrame) -> DataFrame:
    """(label, id, properties) of works(id, ...); identifiers(id, scheme, value) as sorted 'scheme value' texts [GRF-01, AGG-29]."""
    pairs = F.array_sort(F.collect_set(F.struct("scheme", "value")))
    held = identifiers.groupBy("id").agg(pairs.alias("_pairs"))
    rows = works.join(held, "id", "left")
    kept = {c: F.col(c) for c in works.columns if c != "id"}
    of_wikidata = F.filter("_pairs", lambda p: p["scheme"] == "wikidata")
    kept["wikidata_id"] = F.get(F.transform(of_wikidata, lambda p: p["value"]), F.lit(0))
    kept["identifiers"] = F.transform("_pairs", lambda p: F.concat_ws(" ", p["scheme"], p["value"]))
    return rows.select(F.lit("Work").alias("label"), F.col("id").cast("string").alias("id"), properties(kept).alias("properties"))


def _edge(type_: Column | str, start: Column | str, end: Column | str, a: str, b: str, **kept: Column) -> list[Column]:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    held = properties(kept) if kept else F.lit("{}")
    return [
        as_column(type_).alias("type"), as_column(start).alias("start"), as_column(end).alias("end"),
        F.col(a).cast("string").alias("from"), F.col(b).cast("string").alias("to"), held.alias("properties"),
    ]


def composed_edges(works: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges of works(id, composer) to composers that are left, and (reason, n) of the others [GRF-02]."""
    who = entities.select(F.col("id").alias("composer"), "kind", _lookup(KIND_LABELS, F.col("kind")).alias("_label"))
    rows = works.select("id", "composer").join(who, "composer", "left")
    reason = F.when(F.col("kind").isNull(), "orphan works").otherwise(F.concat(F.lit("composer of kind "), "kind"))
    skipped = rows.filter("_label IS NULL").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))
    return rows.filter("_label IS NOT NULL").select(*_edge("COMPOSED_BY", "Work", F.col("_label"), "id", "composer")), skipped


def performed_edges(credits: DataFrame, entities: DataFrame, event_label: str) -> tuple[DataFrame, DataFrame]:
    """One edge a credit(event, entity, role, discipline), and (reason, n) of performers that are no vertices [GRF-02]."""
    who = entities.select(F.col("id").alias("entity"), "kind", _lookup(KIND_LABELS, F.col("kind")).alias("_label"))
    rows = credits.join(who, "entity")
    skipped = rows.filter("_label IS NULL").groupBy(F.concat(F.lit("performer of kind "), "kind").alias("reason")).agg(F.count("*").alias("n"))
    kept = _edge("PERFORMED_IN", F.col("_label"), event_label, "entity", "event", role=F.col("role"), discipline=F.col("discipline"))
    return rows.filter("_label IS NOT NULL").select(*kept), skipped


def programmed_edges(rows: DataFrame, event_label: str) -> tuple[DataFrame, DataFrame]:
    """An edge an event and work of rows(event, work) with times, and (reason, n) of mentions without a work [GRF-02, AGG-10]."""
    times = rows.filter("work IS NOT NULL").groupBy("event", "work").agg(F.count("*").alias("times"))
    skipped = rows.filter("work IS NULL").agg(F.count("*").alias("n")).filter("n > 0").select(F.lit("unmatched mentions").alias("reason"), "n")
    return times.select(*_edge("PROGRAMMED", event_label, "Work", "event", "work", times=F.col("times"))), skipped


def claim_relationships(claims: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An edge a claimed (subject, predicate, object) with its sources, and (reason, n) of those of other kinds [GRF-02, AGG-11]."""
    rows = claims.filter("object IS NOT NULL").groupBy("subject", "predicate", "object").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    for end in ("subject", "object"):
        rows = rows.join(entities.select(F.col("id").alias(end), _lookup(KIND_LABELS, F.col("kind")).alias(f"_{end}")), end, "left")
    good = F.col("predicate").isin(*EDGE_PREDICATES) & F.col("_subject").isNotNull() & F.col("_object").isNotNull()
    skipped = rows.filter(~good).groupBy(F.concat(F.lit("claim "), "predicate").alias("reason")).agg(F.count("*").alias("n"))
    kept = _edge(F.upper("predicate"), F.col("_subject"), F.col("_object"), "subject", "object", sources=F.col("sources"))
    return rows.filter(good).select(*kept), skipped


@dataclass(frozen=True)
class Slice:
    """What a blueprint holds: how many performers (0: all), the least performances of an edge, and which edges."""

    performers: int = 500
    min_weight: int = 1
    performances: bool = True
    claims: bool = True


def blueprint(
    entities: DataFrame, credits: DataFrame, edges: DataFrame, claims: DataFrame, records: DataFrame, cut_at: Slice = Slice()
) -> tuple[DataFrame, DataFrame]:
    """Elements (id, label, json) and connections (from, to, type, json) of a slice of the graph [SRC-16, STR-35, AGG-08].

    entities(id, kind, label), credits(entity, role, recording boolean), edges(performer, composer, weight),
    claims(subject, predicate, object, value, source), records(id, source, url). The most credited performers come
    first, then the composers they lead to, then what these claim; elements without a connection are left out.
    """
    seen = credits.groupBy("entity").agg(
        F.count_if(~F.col("recording")).alias("concerts"), F.count_if("recording").alias("recordings"), F.collect_set("role").alias("roles")
    )
    ranked = seen.orderBy((F.col("concerts") + F.col("recordings")).desc(), F.col("entity").cast("string"))
    top = (ranked.limit(cut_at.performers) if cut_at.performers else seen).select(F.col("entity").alias("performer"))
    played = edges.filter(F.lit(cut_at.performances) & (F.col("weight") >= cut_at.min_weight)).join(top, "performer", "left_semi")
    composers = played.select(F.col("composer").alias("id")).distinct()
    core = top.select(F.col("performer").alias("id")).unionByName(composers).distinct()
    stated = claims.filter(F.lit(cut_at.claims) & F.col("object").isNotNull()).join(core.withColumnRenamed("id", "subject"), "subject", "left_semi")
    stated = stated.groupBy("subject", "predicate", "object").agg(F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"))

    base = [F.col("from").cast("string").alias("from"), F.col("to").cast("string").alias("to"), "type", F.lit("directed").alias("direction")]
    links = played.select(F.col("performer").alias("from"), F.col("composer").alias("to"), F.lit("performed").alias("type"), F.col("weight").alias("Performances"))
    links = links.select(*base, F.to_json(F.struct(*base, "Performances")).alias("json"))
    facts = stated.select(F.col("subject").alias("from"), F.col("object").alias("to"), F.replace("predicate", F.lit("_"), F.lit(" ")).alias("type"), F.col("sources").alias("Sources"))
    links = links.unionByName(facts.select(*base, F.to_json(F.struct(*base, "Sources")).alias("json"))).drop("direction")

    ends = links.select(F.col("from").alias("_id")).unionByName(links.select(F.col("to").alias("_id"))).distinct()
    rows = entities.withColumn("_id", F.col("id").cast("string")).join(ends, "_id", "left_semi")
    rows = rows.join(literals(claims, tuple(MAP_FIELDS) + tuple(MAP_LISTS)).withColumnRenamed("subject", "id"), "id", "left")
    rows = rows.join(provenance(records), "id", "left").join(seen.withColumnRenamed("entity", "id"), "id", "left")
    rows = rows.join(composers.withColumn("_composer", F.lit(True)), "id", "left")
    roles = F.coalesce("roles", F.array().cast("array<string>"))
    roles = F.when(F.col("_composer"), F.array_append(roles, F.lit("composer"))).otherwise(roles)
    tags = F.filter(F.array(*[F.lit(r) for r in ROLE_ORDER]), lambda r: F.array_contains(roles, r))
    return rows.select(F.col("_id").alias("id"), "kind", "label", _element(tags).alias("json")), links


def description(role: Column, born: Column, died: Column, concerts: Column, recordings: Column) -> Column:
    """Roles, years and credits in one line; what is not known, or 0, is left out [STR-35]."""
    year = lambda x: F.nullif(F.regexp_extract(x, r"^\+*([0-9]{4})", 1), F.lit(""))
    n = lambda x, name: F.when(x > 0, F.concat(x, F.lit(name)))
    lived = F.concat_ws("–", year(born), year(died))
    credited = F.concat_ws(", ", n(concerts, " concerts"), n(recordings, " recordings"))
    parts = F.filter(F.array(F.concat(F.upper(F.substring(role, 1, 1)), role.substr(F.lit(2), F.length(role))), lived, credited), lambda p: p != "")
    return F.array_join(parts, " · ")


def _element(tags: Column) -> Column:
    first = {p: F.get(F.col(p), F.lit(0)) for p in MAP_FIELDS}
    some = lambda c: F.when(F.col(c) > 0, F.col(c))
    role = F.array_join(tags, ", ")
    text = description(role, first["born_on"], first["died_on"], F.col("concerts"), F.col("recordings"))
    kept = {
        "id": F.col("_id"), "label": F.col("label"), "type": F.coalesce(_lookup(KIND_LABELS | MAP_KINDS, F.col("kind")), F.initcap("kind")),
        "tags": F.when(F.size(tags) > 0, tags), "description": F.nullif(text, F.lit("")),
    }
    for p, name in MAP_FIELDS.items():
        kept[name] = F.when(first[p].rlike("^[0-9]+$"), first[p].try_cast("bigint")) if p in COUNTS else first[p]
    for p, name in MAP_LISTS.items():
        kept[name] = F.array_join(distinct_spellings(F.col(p)), ", ")
    kept |= {"Concerts": some("concerts"), "Recordings": some("recordings")}
    kept |= {"Sources": F.nullif(F.array_join("sources", ", "), F.lit("")), "Source URL": F.col("url")}
    return F.to_json(F.struct(*[c.alias(k) for k, c in kept.items()]), {"ignoreNullFields": "true"})
