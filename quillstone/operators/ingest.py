"""Incremental upserts as set operations: old table and new documents in, new table out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import content_hash, entity_key, id_of_url, name_uuid

#: Name space of entity ids: RFC 4122's for domain names.
NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def records_of(docs: DataFrame) -> DataFrame:
    """Entity documents as records with key, deterministic entity id and content hash [ING-05, STR-29, STR-31]."""
    rows = docs.filter("_type = 'entity'")
    rows = rows.withColumn("dedup_key", entity_key(F.col("kind"), F.col("name"), id_of_url(F.col("url"))))
    return rows.select(
        F.col("source_name").alias("source"), F.col("id").alias("external_id"), "kind", "name", "language", "url", "raw", "dedup_key",
        name_uuid(NAMESPACE, F.concat_ws(":", "kind", "dedup_key")).alias("entity_id"),
        content_hash(F.col("name"), F.col("url"), F.col("raw")).alias("hash"), "run_id",
    )


def upsert(old: DataFrame, new: DataFrame, key: list[str], changing: list[str], hash_column: str = "hash") -> DataFrame:
    """old with new merged in by key [ING-02, ING-04].

    New keys come in whole; known ones get last_run from new, and `changing` columns only if the hash changed; what
    identifies a row stays; null is a hash like any other. change tells new, changed, same and absent apart.
    """
    o, n = old.select(F.struct(*old.columns).alias("o"), *key), new.select(F.struct(*new.columns).alias("n"), *key)
    both = o.join(n, key, "full_outer")
    isnew, gone = F.col("o").isNull(), F.col("n").isNull()
    changed = ~gone & ~F.col(f"o.{hash_column}").eqNullSafe(F.col(f"n.{hash_column}"))
    change = F.when(isnew, "new").when(gone, "absent").when(changed, "changed").otherwise("same")
    out = []
    for c in old.columns:
        if c in ("first_run", "last_run"):
            value = F.col("n.run_id")
            keep = gone if c == "last_run" else ~isnew
            out.append(F.when(keep, F.col(f"o.{c}")).otherwise(value).alias(c))
        elif c in changing or c == hash_column:
            out.append(F.when(isnew | changed, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.when(isnew, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return both.select(*out, change.alias("change"))


CLAIM_KEY = ["subject", "predicate", "object", "value", "source"]


def claims_of(docs: DataFrame) -> DataFrame:
    """Claims of entity documents by their entity ids, and one that the source mentions each [ING-03, ING-05]."""
    rows = docs.filter("_type = 'entity'")
    subject = name_uuid(NAMESPACE, F.concat_ws(":", "kind", entity_key(F.col("kind"), F.col("name"), id_of_url(F.col("url")))))
    base = rows.withColumn("subject", subject).select("subject", F.col("source_name").alias("source"), "claims")
    each = base.withColumn("c", F.explode("claims")).select("subject", "source", "c.*")
    key = entity_key(F.col("object_kind"), F.col("object_label"), F.col("object_wikidata_id"))
    target = F.when(F.col("object_label").isNotNull(), name_uuid(NAMESPACE, F.concat_ws(":", "object_kind", key)))
    each = each.select("subject", "predicate", target.alias("object"), "value", "source")
    nothing = F.lit(None).cast("string")
    seen = base.select("subject", F.lit("mentioned_in").alias("predicate"), nothing.alias("object"), F.col("source").alias("value"), "source")
    return each.unionByName(seen).distinct()


def append_claims(old: DataFrame, new: DataFrame) -> DataFrame:
    """old and the new claims that it lacks; nulls in keys are equal, and nothing is ever taken away [ING-03]."""
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in CLAIM_KEY])
    same = None
    for c in CLAIM_KEY:
        one = F.col(c).eqNullSafe(F.col(f"o_{c}"))
        same = one if same is None else same & one
    fresh = new.select(*CLAIM_KEY).distinct().join(o, same, "left_anti")
    return old.unionByName(fresh)


def unconfirmed(records: DataFrame, runs: DataFrame) -> DataFrame:
    """(source, records, unconfirmed): records whose last run is not among the source's completed ones [ING-08, AGG-19]."""
    done = runs.filter("status = 'completed'").select("source", F.col("run_id").alias("last_run"), F.lit(True).alias("_done"))
    rows = records.join(done, ["source", "last_run"], "left")
    return rows.groupBy("source").agg(F.count("*").alias("records"), F.count_if(F.col("_done").isNull()).alias("unconfirmed"))


def touched(entities: DataFrame, seen: DataFrame) -> DataFrame:
    """entities(id, last_ingested) with the later of both times [ING-07]. seen(id, at)"""
    latest = seen.groupBy("id").agg(F.max("at").alias("_at"))
    out = entities.join(latest, "id", "left").withColumn("last_ingested", F.greatest("last_ingested", "_at"))
    return out.drop("_at").select(*entities.columns)
