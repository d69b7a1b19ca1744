"""GRF-07, AGG-24, MTH-03: which composers an entity performs, by reach-normalised weight."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.plans import views


def performed_edges(spark: SparkSession, sf_dir: str, top: int = 10) -> DataFrame:
    """Per entity the top composers by affinity = weight / sqrt(reach); ties by weight, then name.

    Programme rows collapse to (event, composer) sums before they meet the participants, so that the join carries one
    row an event and composer instead of one a programme item.
    """
    plays = views.programmed(spark, sf_dir).join(views.composed_by(spark, sf_dir), "work")
    plays = plays.groupBy("event", "composer").agg(F.sum("times").alias("times"))
    reach = plays.groupBy("composer").agg(F.sum("times").alias("reach"))
    edges = (
        views.participants(spark, sf_dir)
        .join(plays, "event")
        .groupBy("entity", "composer")
        .agg(F.sum("times").alias("weight"))
        .join(reach, "composer")
        .withColumn("affinity", F.round(F.col("weight") / F.sqrt(F.greatest("reach", F.lit(1))), 6))
    )
    order = Window.partitionBy("entity").orderBy(F.desc("affinity"), F.desc("weight"), "composer")
    ranked = edges.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select("entity", "composer", "weight", "affinity", "rank")


PERFORMED_SQL = """
WITH plays AS (
  SELECT l_orderkey AS event, p_brand AS composer, count(*) AS times
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
who AS (SELECT DISTINCT l_orderkey AS event, l_suppkey AS entity FROM lineitem),
reach AS (SELECT composer, CAST(sum(times) AS BIGINT) AS reach FROM plays GROUP BY 1),
edges AS (
  SELECT entity, composer, CAST(sum(times) AS BIGINT) AS weight FROM who JOIN plays USING (event) GROUP BY 1, 2),
ranked AS (
  SELECT entity, composer, weight, round(weight / sqrt(greatest(reach, 1)), 6) AS affinity
  FROM edges JOIN reach USING (composer))
SELECT entity, composer, weight, affinity, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY entity ORDER BY affinity DESC, weight DESC, composer) AS INT) AS rank
  FROM ranked)
WHERE rank <= 10
"""
