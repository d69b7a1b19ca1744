"""Joins of tables in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A key is hot if it holds more than one in this many rows: so many keys at most can be.
PARTS = 512


def hot_keys(counts: DataFrame, key: str, n: str, total: int) -> list:
    """The keys of counts(key, n) that hold more than one in PARTS of total rows: fewer than PARTS, whatever the table.

    total may be an upper bound of the rows that counts sums up.
    """
    return [r[0] for r in counts.filter((F.col(n) * PARTS > total) & F.col(key).isNotNull()).select(key).collect()]


def spread_join(rows: DataFrame, side: DataFrame, key: str, hot: list) -> DataFrame:
    """Inner join of rows with side, one row a key, on key. Hot keys' rows stay where they are.

    The side's rows of hot keys, fewer than PARTS, are broadcast; the others meet by a shuffle, which Spark may plan as a
    broadcast if the side is small.
    """
    if not hot:
        return rows.join(side, key)
    is_hot = F.col(key).isin(hot)
    cold = rows.filter(~is_hot).join(side.filter(~is_hot), key)
    return cold.unionByName(rows.filter(is_hot).join(F.broadcast(side.filter(is_hot)), key))


#: Parts in which a key's rows are counted, rows of a block, pairs that a task makes, about, and rows of a block that are
#: paired at once.
SALTS, BLOCK, TASK_PAIRS, CHUNK = 64, 1024, 1 << 22, 128


def pairs_within(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(c_a, c_b) for each column c but keys, of each two rows with equal keys and order_a < order_b.

    Null keys meet nothing. A key's rows are dealt out over blocks of about BLOCK rows, and each two blocks meet in one row, so that no task holds a
    key's pairs; pairs are made where two blocks have met and are not shuffled.
    """
    rows = rows.na.drop(subset=keys).withColumn("_s", F.pmod(F.xxhash64(order), F.lit(SALTS)))
    parts = rows.groupBy(*keys, "_s").agg(F.count("*").alias("_n"))
    parts = parts.withColumn("_n", F.sum("_n").over(Window.partitionBy(*keys)))
    sizes = parts.groupBy(*keys).agg(F.first("_n").alias("n"))
    total = sizes.agg(F.coalesce(F.sum(F.col("n").cast("double") * F.col("n")), F.lit(0.0))).first()[0] / 2
    tasks = max(1, min(20_000, int(total / TASK_PAIRS) + 1))
    dealt = rows.join(parts.filter("_n > 1"), [*keys, "_s"]).withColumn("_k", F.ceil(F.col("_n") / BLOCK).cast("int"))
    dealt = dealt.withColumn("_b", F.pmod(F.xxhash64(order, F.lit(1)), F.col("_k")).cast("int"))
    # Equal values of order share a block, and never pair.
    kept = [c for c in rows.columns if c not in (*keys, "_s")]
    blocks = dealt.groupBy(*keys, "_k", "_b").agg(F.collect_list(F.struct(*kept)).alias("_x"))
    # A list a column: numbers are then read where they lie, and no struct is made a pair.
    blocks = blocks.select(*keys, "_k", "_b", F.struct(*[F.col(f"_x.{c}").alias(c) for c in kept]).alias("_x"))
    x = blocks.select(*keys, F.col("_b").alias("_p"), F.explode(F.sequence("_b", F.col("_k") - 1)).alias("_q"), "_x")
    y = blocks.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_p"), F.col("_b").alias("_q"), F.col("_x").alias("_y"))
    at = [*keys, "_p", "_q"]
    met = x.repartition(tasks, *at).join(y.repartition(tasks, *at).hint("merge"), at)
    met = met.select((F.col("_p") == F.col("_q")).alias("_same"), "_x", "_y")
    # Compiled code keeps all pairs of its input row in memory before the first goes on. transform() is not compiled, so
    # that the code after it starts from CHUNK rows by CHUNK rows.
    met = met.select("_same", _chunks("_x", kept, order), "_y").select("_same", "_x", _chunks("_y", kept, order))
    one = met.select("_same", "_x", "_y", F.posexplode(f"_x.{order}").alias("_i", f"_1{order}"))
    one = one.select("_same", f"_1{order}", *[F.get(f"_x.{c}", F.col("_i")).alias(f"_1{c}") for c in kept if c != order], "_y")
    two = one.select("_same", *[f"_1{c}" for c in kept], "_y", F.posexplode(f"_y.{order}").alias("_j", f"_2{order}"))
    first = F.col(f"_1{order}") < F.col(f"_2{order}")
    pairs = two.filter(~F.col("_same") | first)
    value = {c: (F.col(f"_1{c}"), F.col(f"_2{c}") if c == order else F.get(f"_y.{c}", F.col("_j"))) for c in kept}
    pick = lambda c, one, two: F.when(first, value[c][one]).otherwise(value[c][two])
    return pairs.select(*[pick(c, *ends).alias(f"{c}_{s}") for s, ends in (("a", (0, 1)), ("b", (1, 0))) for c in kept])


def _chunks(lists: str, kept: list[str], order: str):
    """A row for each CHUNK places of a struct of lists."""
    starts = F.sequence(F.lit(1), F.size(f"{lists}.{order}"), F.lit(CHUNK))
    return F.explode(F.transform(starts, lambda at: F.struct(*[F.slice(f"{lists}.{c}", at, F.lit(CHUNK)).alias(c) for c in kept]))).alias(lists)


def pairs_between(x: DataFrame, y: DataFrame, keys: list[str], by: str) -> DataFrame:
    """(keys, x, y): structs of the other columns of each row of x and row of y with equal keys.

    Null keys meet nothing. Both sides are dealt out over blocks by their column by, and each two blocks meet in one row,
    as in pairs_within().
    """
    sides = [(x, "_kx"), (y, "_ky")]
    sides = [(r.na.drop(subset=keys).withColumn("_s", F.pmod(F.xxhash64(by), F.lit(SALTS))), k) for r, k in sides]
    parts = [r.groupBy(*keys, "_s").agg(F.count("*").alias("_n")) for r, _ in sides]
    sizes = [p.groupBy(*keys).agg(F.sum("_n").alias(k)) for p, (_, k) in zip(parts, sides)]
    sizes = sizes[0].join(sizes[1], keys)
    total = sizes.agg(F.coalesce(F.sum(F.col("_kx").cast("double") * F.col("_ky")), F.lit(0.0))).first()[0]
    tasks = max(1, min(20_000, int(total / TASK_PAIRS) + 1))
    sizes = sizes.withColumns({k: F.ceil(F.col(k) / BLOCK).cast("int") for k in ("_kx", "_ky")})
    blocks = []
    for (rows, k), part, name in zip(sides, parts, ("_x", "_y")):
        kept = [c for c in rows.columns if c not in (*keys, "_s")]
        dealt = rows.join(part.select(*keys, "_s").join(sizes, keys), [*keys, "_s"])
        dealt = dealt.withColumn("_b", F.pmod(F.xxhash64(by, F.lit(1)), F.col(k)).cast("int"))
        blocks.append(dealt.groupBy(*keys, "_kx", "_ky", "_b").agg(F.collect_list(F.struct(*kept)).alias(name)))
    each = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    one = blocks[0].select(*keys, F.col("_b").alias("_p"), each("_ky").alias("_q"), "_x")
    two = blocks[1].select(*keys, each("_kx").alias("_p"), F.col("_b").alias("_q"), "_y")
    at = [*keys, "_p", "_q"]
    met = one.repartition(tasks, *at).join(two.repartition(tasks, *at).hint("merge"), at)
    return met.select(*keys, F.explode("_x").alias("x"), "_y").select(*keys, "x", F.explode("_y").alias("y"))
