"""Set-based relational operators: unique lookups, ordered folds, pools, budgets, counts. Survey ids in brackets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collapse_root(entities: DataFrame) -> DataFrame:
    """(id, root): an entity's canonical entity, or itself; one hop [GLD-03]."""
    return entities.select("id", F.coalesce("canonical", "id").alias("root"))


def unique_targets(targets: DataFrame, key: str, target: str) -> DataFrame:
    """(key, target) of keys that exactly one distinct target holds [JON-08]."""
    held = targets.filter(F.col(key).isNotNull()).groupBy(key)
    held = held.agg(F.min(target).alias(target), F.max(target).alias("_other"))
    return held.filter(F.col(target) == F.col("_other")).drop("_other")


def unique_match(rows: DataFrame, targets: DataFrame, key: str, target: str) -> DataFrame:
    """rows with target, where exactly one target holds the row's key; null otherwise [JON-08]."""
    return rows.join(unique_targets(targets, key, target), key, "left")


def two_tier_match(rows: DataFrame, first: DataFrame, second: DataFrame, key: str, target: str) -> DataFrame:
    """As unique_match, by first; by second only if no row of first holds the key at all, ambiguous or not [JON-09]."""
    tier = first.groupBy(key).agg(F.min(target).alias("_a"), F.max(target).alias("_b"), F.count("*").alias("_n"))
    other = unique_targets(second, key, target).withColumnRenamed(target, "_second")
    out = rows.join(tier, key, "left").join(other, key, "left")
    one = F.when(F.col("_n").isNull(), F.col("_second")).when(F.col("_a") == F.col("_b"), F.col("_a"))
    return out.withColumn(target, one).drop("_a", "_b", "_n", "_second")


def values_by_count(claims: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, values: distinct values, the most frequent first, ties in value order; the head is the mode [AGG-12]."""
    counts = claims.groupBy(*by, value).agg(F.count("*").alias("_n"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))))
    return counts.groupBy(*by).agg(F.transform(order, lambda x: x["v"]).alias("values"))


def consensus(claims: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, value: the mode, ties to the least [AGG-15]."""
    counts = claims.groupBy(*by, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def referred(claims: DataFrame, least: int) -> DataFrame:
    """(object, referrers) of objects with at least that many distinct subjects [AGG-07]."""
    out = claims.groupBy("object").agg(F.countDistinct("subject").alias("referrers"))
    return out.filter(F.col("referrers") >= least)


def programme_counts(concerts: DataFrame, recordings: DataFrame) -> DataFrame:
    """entity, concert_count, recording_count, programme_count from (entity, event) rows of either family [AGG-03]."""

    def counted(rows: DataFrame, name: str, other: str) -> DataFrame:
        out = rows.groupBy("entity").agg(F.countDistinct("event").alias(name))
        return out.withColumn(other, F.lit(0).cast("long"))

    both = counted(concerts, "concert_count", "recording_count").unionByName(
        counted(recordings, "recording_count", "concert_count")
    )
    out = both.groupBy("entity").agg(F.sum("concert_count").alias("concert_count"), F.sum("recording_count").alias("recording_count"))
    return out.withColumn("programme_count", F.col("concert_count") + F.col("recording_count"))


def first_wins(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The row of least order for each key; nulls in keys are equal [WIN-03]."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def capped(rows: DataFrame, by: list[str], order: list[Column], most: int, name: str = "place") -> DataFrame:
    """At most so many rows a group, in order [WIN-02]. The cap becomes a partial limit before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn(name, place).filter(F.col(name) <= most)


def dual_rank_pool(edges: DataFrame, by: list[str], most: int, score: str = "score", weight: str = "weight", key: str = "neighbour") -> DataFrame:
    """Edges among the best by score or the best by weight of their group; ties by the other, then by key [WIN-01]."""
    by_score = Window.partitionBy(*by).orderBy(F.desc(score), F.desc(weight), key)
    by_weight = Window.partitionBy(*by).orderBy(F.desc(weight), F.desc(score), key)
    ranked = edges.withColumn("_s", F.row_number().over(by_score)).withColumn("_w", F.row_number().over(by_weight))
    return ranked.filter((F.col("_s") <= most) | (F.col("_w") <= most)).drop("_s", "_w")


def budgeted(edges: DataFrame, by: str, relation: str, order: list[Column], reserve: int, most: int) -> DataFrame:
    """At most `most` rows a group: first up to `reserve` of each relation, in order, then the best of the rest [WIN-04].

    If the reservations alone exceed the budget, the overall order cuts them.
    """
    within = F.row_number().over(Window.partitionBy(by, relation).orderBy(*order))
    rows = edges.withColumn("_spare", (within > reserve).cast("int"))
    return capped(rows, [by], [F.col("_spare"), *order], most).drop("_spare")


def weight_histogram(edges: DataFrame, by: list[str], weight: str = "weight") -> DataFrame:
    """by, weights: sorted (weight, edges) pairs [AGG-25]."""
    counts = edges.groupBy(*by, weight).agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(weight).alias("weight"), "n"))).alias("weights"))


def merge_unique(target: DataFrame, moved: DataFrame, key: list[str]) -> DataFrame:
    """target, and the moved rows whose key it does not hold, one a key [SET-05]."""
    fresh = moved.dropDuplicates(key).join(target.select(*key), key, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def paged(rows: DataFrame, order: list[Column], page: int = 1, limit: int = 20) -> DataFrame:
    """One page, from 1 on; the limit is held to 1..100 [SRT-02]."""
    limit = max(1, min(100, limit))
    return rows.orderBy(*order).offset((max(1, page) - 1) * limit).limit(limit)


def quarantine(claims: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Claims whose (predicate, kind) the vocabulary does not allow [FLT-11]."""
    return claims.join(vocabulary, ["predicate", "kind"], "left_anti")


def shared_key_pairs(rows: DataFrame, holder: str, key: list[str], most: int) -> DataFrame:
    """(a, b, shared): holders a < b and how many keys they share, among keys of 2 to `most` holders [JON-12].

    The cap is the operator's meaning, a key that many hold says little, and it bounds a key's pairs.
    """
    held = rows.select(holder, *key).distinct()
    some = held.groupBy(*key).agg(F.count("*").alias("_n")).filter((F.col("_n") > 1) & (F.col("_n") <= most)).drop("_n")
    held = held.join(some, key)
    a, b = held.withColumnRenamed(holder, "a"), held.withColumnRenamed(holder, "b")
    return a.join(b, key).filter("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
