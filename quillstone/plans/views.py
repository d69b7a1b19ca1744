"""The driver's tables seen as the engine's abstract tables: events, works, composers, participants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def programmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event, work, times): how often an event's programme lists a work."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("times"))
    return rows.withColumnsRenamed({"l_orderkey": "event", "l_partkey": "work"})


def composed_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(work, composer)"""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("work"), F.col("p_brand").alias("composer"))


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event, entity), each pair once"""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event"), F.col("l_suppkey").alias("entity"))
    return rows.distinct()
