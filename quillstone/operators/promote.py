"""Curation: evidence filter, duplicate collapse, reachability prune. Tables in, tables out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.operators.fixpoint import reachable
from quillstone.operators.relational import collapse_root, first_wins


@dataclass(frozen=True)
class EvidenceRules:
    """Thresholds of the evidence filter; None turns a path off. The toggles leave a rule out [GLD-06]."""

    min_concerts: int = 2
    min_recordings: int = 2
    min_credits: int = 0
    min_works: int = 2
    min_programmes: int = 3
    min_sitelinks: int | None = 50
    min_referrers: int = 2
    drop: bool = True
    collapse: bool = True
    prune: bool = True


def evidenced(roots: DataFrame, counts: DataFrame, rules: EvidenceRules) -> DataFrame:
    """(root) with enough appearances, or credits with works or programmes, or sitelinks; no row counts as 0 [GLD-01].

    counts(root, concerts, recordings, credits, works, programmes, sitelinks)
    """
    if not rules.drop:
        return roots.select("root").distinct()
    rows = roots.select("root").distinct().join(counts, "root", "left")
    n = {c: F.coalesce(F.col(c), F.lit(0)) for c in counts.columns if c != "root"}
    seen = (n["concerts"] >= rules.min_concerts) | (n["recordings"] >= rules.min_recordings)
    played = (n["credits"] >= rules.min_credits) & ((n["works"] >= rules.min_works) | (n["programmes"] >= rules.min_programmes))
    known = F.lit(False) if rules.min_sitelinks is None else n["sitelinks"] >= rules.min_sitelinks
    return rows.filter(seen | played | known).select("root")


def collapse_claims(claims: DataFrame, entities: DataFrame, rules: EvidenceRules = EvidenceRules()) -> DataFrame:
    """claims(id, subject, predicate, object, value, source) re-pointed to roots; of equal ones the first by id [GLD-03]."""
    if not rules.collapse:
        return claims
    roots = collapse_root(entities)
    s = roots.select(F.col("id").alias("subject"), F.col("root").alias("_s"))
    o = roots.select(F.col("id").alias("object"), F.col("root").alias("_o"))
    out = claims.join(s, "subject", "left").join(o, "object", "left")
    out = out.withColumns({"subject": F.coalesce("_s", "subject"), "object": F.coalesce("_o", "object")}).select(*claims.columns)
    return first_wins(out, ["subject", "predicate", "object", "value", "source"], "id")


def kept_entities(kept: DataFrame, claims: DataFrame, entities: DataFrame, rules: EvidenceRules) -> DataFrame:
    """(node): kept persons and ensembles, and what their claims reach without entering a dropped one [GLD-04, GLD-05].

    entities(id, kind); a seed is an object that min_referrers kept ones share.
    """
    if not rules.prune:
        return entities.select(F.col("id").alias("node"))
    actors = entities.filter(F.col("kind").isin("person", "ensemble")).select(F.col("id").alias("node"))
    edges = claims.filter("object is not null").select(F.col("subject").alias("parent"), F.col("object").alias("child"))
    referred = edges.join(kept.select(F.col("root").alias("parent")), "parent", "left_semi")
    referred = referred.groupBy("child").agg(F.countDistinct("parent").alias("n")).filter(F.col("n") >= rules.min_referrers)
    seeds = referred.select(F.col("child").alias("node")).join(actors, "node", "left_anti")
    venues = entities.filter("kind = 'venue'").select(F.col("id").alias("node"))
    others = reachable(edges, seeds.unionByName(venues), actors)
    return others.unionByName(kept.select(F.col("root").alias("node"))).distinct()


def surviving_claims(claims: DataFrame, nodes: DataFrame) -> DataFrame:
    """Claims of kept subjects whose object is kept, or a literal [GLD-07, GLD-08]."""
    keep = nodes.select(F.col("node").alias("subject"))
    out = claims.join(keep, "subject", "left_semi")
    to = nodes.select(F.col("node").alias("object"), F.lit(True).alias("_kept")).distinct()
    out = out.join(to, "object", "left").filter(F.col("object").isNull() | F.col("_kept"))
    return out.select(*claims.columns)


def nulled(rows: DataFrame, column: str, nodes: DataFrame) -> DataFrame:
    """rows with column null where it points to nothing kept [GLD-10, GLD-12]."""
    to = nodes.select(F.col("node").alias(column), F.lit(True).alias("_kept")).distinct()
    out = rows.join(to, column, "left").withColumn(column, F.when(F.col("_kept"), F.col(column)))
    return out.select(*rows.columns)
