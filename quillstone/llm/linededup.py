"""Operator 6, line dedup: repeated runs of lines by prefix doubling over line ids. JVM side only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import Scratch, word_count

#: What tells documents apart and puts them in order: doc_id (nulls last), then the hash of the text.
DOC = ("_none", "_id", "_text")


@dataclass(frozen=True)
class LineRules:
    """A run of lines is a copy worth deleting if it has at least min_words words."""

    min_words: int = 50


def _identity(docs: DataFrame) -> dict[str, Column]:
    return {
        "_none": F.col("doc_id").isNull(),
        "_id": F.coalesce("doc_id", F.lit(0)).cast("long"),
        "_text": F.xxhash64("text"),
    }


def _lines(docs: DataFrame, rules: LineRules) -> DataFrame:
    """One row a line: document, place i, two hashes, and the shortest runs of min_words words that start (x lines)
    and end (y lines) there; null where the document has no such run."""
    rows = docs.select(*[c.alias(k) for k, c in _identity(docs).items()], F.posexplode(F.split("text", "\n")))
    line = F.col("col")
    rows = rows.select(
        *DOC, F.col("pos").alias("i"), F.xxhash64(line).alias("h1"), F.xxhash64(line, F.lit("2")).alias("h2"),
        word_count(line).alias("w"),
    )
    # One shuffle serves the removal of repeated rows and all windows.
    rows = rows.repartition(*DOC).distinct()
    upto = F.sum("w").over(Window.partitionBy(*DOC).orderBy("i"))
    rows = rows.withColumn("c", upto).withColumn("b", F.col("c") - F.col("w"))
    # Words before a line never fall, so that the lines less than min_words words on are a range of them.
    ahead = Window.partitionBy(*DOC).orderBy("b").rangeBetween(0, rules.min_words - 1)
    back = Window.partitionBy(*DOC).orderBy("c").rangeBetween(1 - rules.min_words, 0)
    x = F.when(F.max("c").over(ahead) - F.col("b") >= rules.min_words, F.max("i").over(ahead) - F.col("i") + 1)
    y = F.when(F.col("c") - F.min("b").over(back) >= rules.min_words, F.col("i") - F.min("i").over(back) + 1)
    return rows.select(*DOC, "i", "h1", "h2", x.alias("x"), y.alias("y"))


def _ranks(rows: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """(key, key, rank) of the key pairs that at least two rows hold; ranks are in the order of the pairs.

    Pairs are counted first; the counted pairs, not the rows, are sorted by range, and a pair's rank is its partition
    and its place there. Must be saved before use, as the places hold only for one run of the sort.
    """
    pairs = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys)
    return pairs.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id())


def repeated_runs(docs: DataFrame, rules: LineRules, scratch: Scratch) -> DataFrame:
    """(document, a, b): the lines from a up to b, without b, that later copies of runs cover.

    Prefix doubling: a position's rank at level k is the rank of the 2**k lines from there, among positions whose 2**k
    lines occur again; others drop out, and with them all longer runs that they start. Two positions' ranks compare as
    their lines do, so that the ranks of a level are the suffix array by 2**k lines, and a rank's positions are an
    interval of suffixes with a common prefix of that length. The ranks at both ends of a run, at the level of half its
    length or more, name the run; positions with equal names are the interval of suffixes that share it, of which all
    but the earliest position are later copies.

    It is enough to name the shortest runs of min_words words from each line on and up to each line: each line of a
    longer repeated run lies in one of those that the run contains, and a copy of such a run is again one.
    """
    lines = scratch.save(_lines(docs, rules), "lines")
    longest = lines.agg(F.max(F.greatest("x", "y"))).first()[0] or 0
    ranks = scratch.save(_ranks(lines, ("h1", "h2")), "ranks")
    level = lines.join(ranks, ["h1", "h2"]).select(*DOC, "i", "rank")
    level = scratch.save(level, "level")
    levels = [level.withColumn("k", F.lit(0))]
    for k in range(1, max(1, longest).bit_length()):
        half = 1 << (k - 1)
        there = Window.partitionBy(*DOC).orderBy("i").rangeBetween(half, half)
        pairs = level.select(*DOC, "i", F.col("rank").alias("r1"), F.max("rank").over(there).alias("r2"))
        pairs = scratch.save(pairs.filter("r2 is not null"), "pairs")
        ranks = scratch.save(_ranks(pairs, ("r1", "r2")), "ranks")
        level = scratch.save(pairs.join(ranks, ["r1", "r2"]).select(*DOC, "i", "rank"), "level")
        scratch.drop(pairs)
        if level.isEmpty():
            break
        levels.append(level.withColumn("k", F.lit(k)))
    found = levels[0]
    for one in levels[1:]:
        found = found.unionByName(one)
    first = lines.filter("x is not null").select(*DOC, F.col("i").alias("a"), F.col("x").alias("n"))
    last = lines.filter("y is not null").select(*DOC, (F.col("i") - F.col("y") + 1).alias("a"), F.col("y").alias("n"))
    runs = first.unionByName(last).distinct()
    runs = runs.withColumn("k", F.floor(F.log2("n")).cast("int"))
    runs = runs.withColumn("z", (F.col("a") + F.col("n") - F.pow(F.lit(2), F.col("k"))).cast("int"))
    front = found.select(*DOC, F.col("i").alias("a"), "k", F.col("rank").alias("r1"))
    rear = found.select(*DOC, F.col("i").alias("z"), "k", F.col("rank").alias("r2"))
    runs = runs.join(front, [*DOC, "a", "k"]).join(rear, [*DOC, "z", "k"]).select(*DOC, "a", "n", "r1", "r2")
    runs = scratch.save(runs, "runs")
    place = F.struct(*DOC, "a")
    groups = runs.groupBy("n", "r1", "r2").agg(F.count("*").alias("copies"), F.min(place).alias("earliest"))
    # Written first, so that the join's sides are plain shuffles, whose large partitions Spark can split.
    groups = scratch.save(groups.filter("copies > 1").drop("copies"), "groups")
    scratch.keep(runs, groups)
    later = runs.join(groups, ["n", "r1", "r2"]).filter(place != F.col("earliest"))
    return _merged(later.select(*DOC, "a", (F.col("a") + F.col("n")).alias("b")))


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a document as one."""
    order = Window.partitionBy(*DOC).orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.when(F.col("a") <= reach, 0).otherwise(1))
    spans = spans.withColumn("part", F.sum("opens").over(order))
    return spans.groupBy(*DOC, "part").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("part")


def line_dedup(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """docs(doc_id, text, ...) without the lines of later copies, and with n_lines and n_cut, the lines deleted.

    A line goes if it lies in a run of consecutive lines with min_words words or more that also stands earlier: in a
    document of lower doc_id, or higher up in the same one. Lines are what newlines part; equal lines are equal strings.
    A text that loses every line becomes empty. Null texts stay null, with no lines; null ids come last; rows of equal
    doc_id go by the hash of their text; rows equal in both are one document, listed as often. An input column named
    n_lines or n_cut is replaced; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "linededup")
    spans = repeated_runs(docs.select("doc_id", "text").filter(F.col("text").isNotNull()), rules, scratch)
    cuts = F.array_sort(F.collect_list(F.struct("a", "b"))).alias("_cuts")
    cuts = spans.groupBy(*[F.col(c).alias(c + "_") for c in DOC]).agg(cuts)
    keep = [c for c in docs.columns if c not in ("n_lines", "n_cut")]
    rows = docs.select(F.struct(*keep).alias("_row"), *[c.alias(k) for k, c in _identity(docs).items()])
    rows = rows.join(cuts, [F.col(c) == F.col(c + "_") for c in DOC], "left")
    rows = rows.select("_row", "_cuts", F.split("_row.text", "\n").alias("_lines"))
    # Cuts are in order and apart: what stays is what lies between them.
    since = lambda k: F.coalesce(F.get("_cuts.b", k - 1), F.lit(0))
    upto = lambda k: F.coalesce(F.get("_cuts.a", k), F.size("_lines"))
    between = F.sequence(F.lit(0), F.size("_cuts"))
    stays = F.flatten(F.transform(between, lambda k: F.slice("_lines", since(k) + 1, upto(k) - since(k))))
    rows = rows.select("_row", "_cuts", "_lines", F.when(F.col("_cuts").isNotNull(), stays).alias("_stays"))
    text = F.when(F.col("_stays").isNull(), F.col("_row.text")).otherwise(F.array_join("_stays", "\n"))
    size = F.coalesce(F.size("_lines"), F.lit(0)).cast("long")
    size = F.when(F.col("_lines").isNull(), F.lit(0).cast("long")).otherwise(size)
    cut = F.when(F.col("_stays").isNull(), F.lit(0)).otherwise(F.size("_lines") - F.size("_stays")).cast("long")
    out = [text.alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in keep]
    return rows.select(*out, size.alias("n_lines"), cut.alias("n_cut"))
