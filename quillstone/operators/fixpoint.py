"""Iterations to a fixpoint: closure, reachability, components. Each round is checkpointed to the shared folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint.

    The folder is the session's; only a session within one JVM may go without and gets a temporary one.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not context._jsc.sc().isLocal():
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="quillstone-checkpoint-"))
    return df.checkpoint()


def closure(edges: DataFrame, seeds: DataFrame, most: int = 64) -> DataFrame:
    """(root, node): what each seed reaches over edges(parent, child), itself included; cycles end [GRF-04, SET-02].

    Only pairs found in the last round are joined again; the visited pairs drop out by an anti join.
    """
    seen = frontier = cut(seeds.select(F.col("node").alias("root"), "node").distinct())
    step = edges.select(F.col("parent").alias("node"), "child").distinct()
    for _ in range(most):
        found = frontier.join(step, "node").select("root", F.col("child").alias("node")).distinct()
        frontier = cut(found.join(seen, ["root", "node"], "left_anti"))
        if frontier.isEmpty():
            return seen
        seen = cut(seen.unionByName(frontier))
    raise RuntimeError(f"no fixpoint after {most} rounds")


def reachable(edges: DataFrame, seeds: DataFrame, barred: DataFrame, most: int = 64) -> DataFrame:
    """(node): the seeds, and all that they reach over edges(parent, child) without entering barred(node) [GLD-05]."""
    seen = frontier = cut(seeds.select("node").distinct())
    step = edges.select(F.col("parent").alias("node"), "child").distinct()
    step = step.join(barred.select(F.col("node").alias("child")), "child", "left_anti")
    for _ in range(most):
        found = frontier.join(step, "node").select(F.col("child").alias("node")).distinct()
        frontier = cut(found.join(seen, "node", "left_anti"))
        if frontier.isEmpty():
            return seen
        seen = cut(seen.unionByName(frontier))
    raise RuntimeError(f"no fixpoint after {most} rounds")


def _signature(edges: DataFrame) -> tuple:
    """Count and two 64-bit sums: a set of rows and another one agree in all three by chance once in 2**128."""
    sums = [F.sum(F.xxhash64("u", "v", F.lit(k)).cast("decimal(38,0)")) for k in (1, 2)]
    return tuple(edges.agg(F.count("*"), *sums).first())


#: A node's edges are met in so many parts at most, so that a hub is no task of its own.
SALTS = 64


def _to_least(rows: DataFrame, wanted: str) -> DataFrame:
    """rows(u, v) that meet a condition on u, v and m, the least of u's neighbours and u, as (v, m)."""
    salted = rows.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    parts = salted.groupBy("u", "s").agg(F.min("v").alias("m"))
    least = parts.withColumn("m", F.least(F.min("m").over(Window.partitionBy("u")), F.col("u")))
    # Sizes that Spark guesses behind a checkpoint or a generator are too small to broadcast by.
    return salted.join(least.hint("merge"), ["u", "s"]).filter(wanted).select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(
    edges: DataFrame, save: Callable[[DataFrame], DataFrame] = cut, drop: Callable[[DataFrame], None] = lambda df: None
) -> DataFrame:
    """(node, root): root is the least node of the component of edges(a, b), by alternating large and small stars.

    Rows stay as many as the edges, and rounds grow with the logarithm of the component's size. save() writes what a
    round leaves to the shared folder and reads it again; drop() may delete it once the next round is there. Only counts
    and sums come to the driver. Loops (a = b) are no edges; without edges there are no rows.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, mark = save(e), None
    while True:
        now = _signature(e)
        if now == mark or now[0] == 0:
            break
        mark = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, "v > u").distinct()
        rest = _to_least(large, "v > m")
        ends = large.groupBy("u").agg(F.min("v").alias("v"))
        after = save(rest.unionByName(ends).distinct())
        drop(e)
        e = after
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
