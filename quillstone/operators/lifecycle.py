"""Runs, rebuilds and promotion: the order in which tables follow from one another, and what survives it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions.payloads import premiere_of
from quillstone.functions.text import date_order, title_key
from quillstone.operators import ingest, promote
from quillstone.operators.relational import collapse_root, first_wins
from quillstone.sources.bronze import Bucket
from quillstone.sources.build import Build

Tables = dict[str, DataFrame]

#: The order in which derived tables are made: each reads what those before it made [ING-12].
DERIVED_ORDER = ("places", "genres", "ensembles", "merge", "links", "work_entities", "concerts", "recordings")


def run(work: Callable[[], dict[str, int]], run_id: str, source: str, now: Callable[[], datetime] | None = None) -> dict:
    """A run's row: work()'s counts and completed, or failed with the error and the counts that it had got to [ING-09].

    An error's `counts`, if it has any, are the partial ones; the error itself is not raised again.
    """
    now = now or (lambda: datetime.now(timezone.utc))
    row = {"run_id": run_id, "source": source, "status": "running", "started_at": now().isoformat(), "error": None}
    try:
        row |= work() | {"status": "completed"}
    except Exception as error:
        row |= getattr(error, "counts", {}) | {"status": "failed", "error": str(error)[:500]}
    return row | {"finished_at": now().isoformat()}


def confirmed(records: DataFrame, seen: DataFrame, run_id: str, completed: bool) -> DataFrame:
    """records(source, external_id, last_run, ...) whose last run moves to this one, if it completed and saw them [ING-08]."""
    if not completed:
        return records
    keys = seen.select("source", "external_id", F.lit(True).alias("_seen")).distinct()
    out = records.join(keys, ["source", "external_id"], "left")
    return out.withColumn("last_run", F.when(F.col("_seen"), F.lit(run_id)).otherwise(F.col("last_run"))).select(*records.columns)


def sources_of(rows: DataFrame, known: DataFrame) -> DataFrame:
    """known(id, name) and an id for each new name of rows(source), in name order [ING-15]."""
    fresh = rows.select(F.col("source").alias("name")).distinct().join(known, "name", "left_anti")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("top"))
    # One row a source: a sorted list of names is small, and its places are the new ids.
    listed = fresh.agg(F.array_sort(F.collect_list("name")).alias("names")).crossJoin(F.broadcast(top))
    new = listed.select("top", F.posexplode("names").alias("at", "name"))
    return known.select("id", "name").unionByName(new.select((F.col("top") + F.col("at") + 1).alias("id"), "name"))


def premieres(works: DataFrame, mentions: DataFrame) -> DataFrame:
    """works(work, premiere_date, premiere_place, premiere_source) with the earliest premiere that mentions state [ING-06].

    mentions(work, id, source, raw). Date, place and source are one claim's; what a work has stays unless an earlier or
    finer date is there, and of equal dates the first mention's wins.
    """
    said = mentions.withColumn("p", premiere_of(F.col("raw"))).filter("p IS NOT NULL")
    said = said.select("work", F.col("p.date").alias("date"), F.col("p.place").alias("place"), F.col("source"), F.col("id").cast("long").alias("at"))
    had = works.filter("premiere_date IS NOT NULL").select(
        "work", F.col("premiere_date").alias("date"), F.col("premiere_place").alias("place"), F.col("premiere_source").alias("source"), F.lit(-1).cast("long").alias("at")
    )
    best = F.min_by(F.struct("date", "place", "source"), F.struct(date_order(F.col("date")), F.col("at"))).alias("b")
    won = said.unionByName(had).groupBy("work").agg(best)
    rest = [c for c in works.columns if not c.startswith("premiere_")]
    out = works.select(*rest).join(won, "work", "left")
    return out.select(*rest, F.col("b.date").alias("premiere_date"), F.col("b.place").alias("premiere_place"), F.col("b.source").alias("premiere_source"))


def preload(records: DataFrame) -> DataFrame:
    """(source, external_id, entity_id, hash, last_run): what an incremental run must know of the records so far [ING-01]."""
    return records.select("source", "external_id", "entity_id", "hash", "last_run")


def carried_people(decisions: DataFrame, entities: DataFrame) -> DataFrame:
    """Human decisions(duplicate, canonical, status) whose people both still exist [ING-11]."""
    out = decisions.filter(F.col("status").isin("accepted", "rejected"))
    for end in ("duplicate", "canonical"):
        out = out.join(entities.select(F.col("id").alias(end)), end, "left_semi")
    return out.select(*decisions.columns)


def carried_works(decisions: DataFrame, mentions: DataFrame, works: DataFrame) -> DataFrame:
    """(source, external_id, work, created) of decisions(source, external_id, composer, title) on mentions that still exist [ING-11].

    The work is the composer's of that title, the least of several; one that is gone is made anew, with an id of composer
    and title, so that equal decisions make one.
    """
    key = title_key(F.col("title"))
    have = works.groupBy("composer", title_key(F.col("title")).alias("k")).agg(F.min("work").alias("_work"))
    kept = decisions.join(mentions.select("source", "external_id").distinct(), ["source", "external_id"], "left_semi").withColumn("k", key)
    c, h = kept.alias("c"), have.alias("h")
    rows = c.join(h, F.col("c.composer").eqNullSafe(F.col("h.composer")) & (F.col("c.k") == F.col("h.k")), "left")
    made = ingest.name_uuid(ingest.NAMESPACE, F.concat_ws("\0", F.lit("work"), F.coalesce("c.composer", F.lit("")), "c.k"))
    return rows.select("source", "external_id", F.coalesce(F.col("_work").cast("string"), made).alias("work"), F.col("_work").isNull().alias("created"))


def derived(tables: Tables, passes: dict[str, Callable[[Tables], Tables]]) -> Tables:
    """tables and what each pass makes of them, in DERIVED_ORDER; a pass that is not given is left out [ING-12]."""
    unknown = set(passes) - set(DERIVED_ORDER)
    if unknown:
        raise ValueError(f"no place in the order: {sorted(unknown)}")
    for name in DERIVED_ORDER:
        if name in passes:
            tables = tables | passes[name](tables)
    return tables


def rebuilt(
    spark: SparkSession, bucket: Bucket, target: Build, sources: list[str], decisions: DataFrame | None = None,
    passes: dict[str, Callable[[Tables], Tables]] | None = None,
) -> dict:
    """The whole table set out of the snapshots, taken over in one step, or an error and the old one stays [ING-10].

    Every loadable run of every source is replayed, failed ones too, oldest first; people's decisions whose ends still
    exist are carried over; derived tables follow in order. A replay without records is refused.
    """

    def make() -> Tables:
        docs = None
        for source in sources:
            found = bucket.latest(source, bucket.loadable(source, replay=True))
            docs = found if docs is None else docs.unionByName(found)
        records = ingest.records_of(docs)
        entities = records.groupBy(F.col("entity_id").alias("id"), "kind").agg(F.min_by("name", F.struct("source", "external_id")).alias("label"))
        tables = {"records": records, "entities": entities, "claims": ingest.claims_of(docs)}
        if decisions is not None:
            tables["decisions"] = carried_people(decisions, entities)
        return derived(tables, passes or {})

    return target.run(make, refuse_empty="records")


def copied(rows: DataFrame, roots: DataFrame, column: str, kept: DataFrame, key: list[str]) -> DataFrame:
    """rows whose entity is kept, pointing at its root; of rows then equal in key the first by id [GLD-09]."""
    at = roots.select(F.col("id").alias(column), "root")
    out = rows.join(at, column).join(kept.select(F.col("node").alias("root")), "root", "left_semi")
    out = out.withColumn(column, F.col("root")).select(*rows.columns)
    return first_wins(out, key, "id")


def promoted(tables: Tables, counts: DataFrame, rules: promote.EvidenceRules = promote.EvidenceRules()) -> Tables:
    """The curated tables: sources and runs whole, kept entities without pointers, their records and claims [GLD-15].

    tables: entities(id, kind, label, canonical), claims, records(id, entity, ...), sources, runs. counts: evidence by root.
    """
    entities = tables["entities"]
    roots = collapse_root(entities)
    claims = promote.collapse_claims(tables["claims"], entities, rules)
    heads = roots.select("root").distinct().join(entities.select(F.col("id").alias("root"), "kind"), "root")
    kept = promote.evidenced(heads.filter(F.col("kind").isin("person", "ensemble")).select("root"), counts, rules)
    nodes = promote.kept_entities(kept, claims, heads.select(F.col("root").alias("id"), "kind"), rules)
    rows = entities.join(nodes.select(F.col("node").alias("id")), "id", "left_semi")
    return {
        "sources": tables["sources"], "runs": tables["runs"],
        "entities": rows.withColumn("canonical", F.lit(None).cast(entities.schema["canonical"].dataType)),
        "records": copied(tables["records"], roots, "entity", nodes, ["source", "external_id"]),
        "claims": promote.surviving_claims(claims, nodes),
    }
