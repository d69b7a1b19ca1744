"""Operator 7, mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import Scratch, word_count


@dataclass(frozen=True)
class MixRules:
    """Sources in code point order, null last, take the weights in turn. budget: the mix's words over all words."""

    weights: tuple[int, ...] = (5, 2, 1)
    budget: float = 1.5
    max_epochs: int = 2
    seed: str = "mix-1"


def source_targets(sizes: DataFrame, rules: MixRules) -> DataFrame:
    """Target words of each source: weight times a common rate, at most max_epochs times the source's words.

    sizes(source, source_size) has one row a source. Resharing the excess again and again ends where the sources below
    some ratio of limit to weight are at their limit and the others share the rest by weight, so that one ordered pass
    over the sources finds it: the first source whose limit is no longer under its share sets the rate.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(rules.weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in rules.weights]), turn + 1).cast("long")
    out = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * rules.max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * rules.budget
    out = out.withColumn("rate", (total - F.coalesce(F.sum("cap").over(below), F.lit(0))) / F.sum("weight").over(rest))
    free = F.when(F.col("cap") >= F.col("rate") * F.col("weight"), F.col("rate"))
    # Nulls: every source is at its limit.
    out = out.withColumn("common", F.max(free).over(Window.partitionBy()))
    share = F.coalesce(F.col("common") * F.col("weight"), F.col("cap").cast("double"))
    return out.select("source", "source_size", "weight", F.least(share, F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """Each row of docs(doc_id, text, source) with the words that the mix takes from it, in order of finish time.

    Within a source documents queue in a fixed random order (MD5 of seed and doc_id), then queue again for each further
    epoch. A copy's virtual finish time is the words its source has queued up to it, over the source's target. All
    copies of all sources are sorted by finish time, by range, and the mix ends where their running sum of words has
    spent the budget. Each source has had its fair share at time 1: the copy in service then is two pieces, its first
    words finish at time 1 and the rest later, so that a source's words are its target to within one word.

    Null texts have no words and are never taken; null sources are one source, the last; rows of equal doc_id queue by
    their size; an empty table gives an empty one; other columns are ignored. Running sums go by 4096 hash ranges of a
    source first and within each range then, so that no task holds a source; the sorted pieces are summed by range
    first, then within the one range in which the budget ends.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.save(_sized(docs.select("doc_id", "source", "text"), rules), "sized")
    starts = scratch.save(_starts(sized, rules), "starts")
    rows = scratch.save(_queued(sized, starts), "queue")
    out = rows.withColumn("taken", _taken(rules, _end_time(rows, rules, scratch)))
    scratch.keep(rows)
    out = out.withColumn("finish", _finish(F.col("start") + F.col("size")))
    out = out.select("doc_id", "source", "size", "source_size", "target", "taken", "finish")
    return out.orderBy(F.col("finish").asc_nulls_last(), F.col("source").asc_nulls_last(), F.col("doc_id").asc_nulls_last())


def mixed_documents(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """docs(doc_id, text, source, ...), each row as often as the mix takes it: whole copies, the cut one too.

    Every row queues on its own, with all its columns; rows equal in doc_id and size queue by the hash of their text.
    Texts move once, after the end of the mix is known from sizes alone.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("_text"), F.struct(*docs.columns).alias("_row"))
    sized = scratch.save(_sized(rows.drop("_row"), rules, "_text"), "sized")
    starts = scratch.save(_starts(sized, rules), "starts")
    end = _end_time(_queued(sized, starts, "_text"), rules, scratch)
    scratch.keep(starts)
    taken = _queued(_sized(rows, rules, "_text", "_row"), starts, "_text", "_row").withColumn("taken", _taken(rules, end))
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    return taken.filter("taken > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).select("_row.*")


def _sized(docs: DataFrame, rules: MixRules, *carried: str) -> DataFrame:
    """Each row's words, its place in the fixed random order (_key, of which _range is the beginning), and QUEUE's columns."""
    key = F.md5(F.concat(F.lit(rules.seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key"), *carried)
    none = F.col("source").isNull()
    return rows.withColumns({"_none": none, "_source": F.coalesce("source", F.lit("")), "_range": F.substring("_key", 1, 3)})


#: What tells the parts of the queues apart. The window and the join go by these, so that rows move once for both.
QUEUE = ("_none", "_source", "_range")


def _starts(sized: DataFrame, rules: MixRules) -> DataFrame:
    """Of each part of a queue: the words queued before it, and the source's size, target and target in whole words."""
    by_range = sized.groupBy("source", *QUEUE).agg(F.sum("size").alias("_words"))
    targets = source_targets(by_range.groupBy("source").agg(F.sum("_words").alias("source_size")), rules)
    ranges = by_range.withColumn(
        "_start", F.sum("_words").over(Window.partitionBy("_none", "_source").orderBy("_range")) - F.col("_words")
    )
    both = ranges.join(targets, ranges["source"].eqNullSafe(targets["source"]))
    return both.select(*QUEUE, "_start", "source_size", "target", F.round("target").cast("long").alias("words"))


def _queued(sized: DataFrame, starts: DataFrame, *carried: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, words, start): start is what the source has queued before the row.

    Columns carried stay; the first of them breaks ties of the queue.
    """
    queue = Window.partitionBy(*QUEUE).orderBy("_key", "size", F.col("doc_id").asc_nulls_last(), *carried[:1])
    before = F.sum("size").over(queue.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    rows = sized.withColumn("_before", before).join(starts, list(QUEUE))
    start = (F.col("_start") + F.col("_before")).alias("start")
    return rows.select("doc_id", "source", "size", "source_size", "target", "words", start, *carried)


def _finish(upto: Column) -> Column:
    """Virtual time at which a source has served so many words; null for one with none to serve."""
    return F.try_divide(upto.cast("double"), F.col("words").cast("double"))


def _pieces(rules: MixRules) -> Column:
    """array<struct<finish, n>> of a queued row: its copies, the one in service at time 1 as two pieces."""
    out = []
    for k in range(rules.max_epochs):
        start = F.col("start") + F.col("source_size") * k
        first = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("words") - start))
        for upto, n in ((start + first, first), (start + F.col("size"), F.col("size") - first)):
            finish = F.coalesce(_finish(upto), F.lit(float("inf")))
            out.append(F.when(n > 0, F.struct(finish.alias("finish"), n.alias("n"))))
    return F.array_compact(F.array(*out))


def _end_time(rows: DataFrame, rules: MixRules, scratch: Scratch) -> float:
    """Finish time of the last of the sorted pieces whose running sum of words is within the budget.

    Sums of ranges come to the driver, one a partition. Pieces of equal finish time stay or go together.
    """
    pieces = rows.select(F.inline(_pieces(rules))).repartitionByRange("finish").withColumn("part", F.spark_partition_id())
    pieces = scratch.save(pieces, "pieces")
    budget = rows.select("source", "words").distinct().agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    before, end = 0, 0.0
    for part, n, latest in sorted(pieces.groupBy("part").agg(F.sum("n"), F.max("finish")).collect()):
        if before + n > budget:
            upto = F.sum("n").over(Window.partitionBy("part").orderBy("finish")) + before
            within = pieces.filter(F.col("part") == part).withColumn("upto", upto).filter(F.col("upto") <= budget)
            return within.agg(F.coalesce(F.max("finish"), F.lit(end))).first()[0]
        before, end = before + n, latest
    return end


def _taken(rules: MixRules, end: float) -> Column:
    """Words of a queued row's pieces that finish by the end of the mix."""
    return F.aggregate(_pieces(rules), F.lit(0).cast("long"), lambda a, p: a + F.when(p["finish"] <= end, p["n"]).otherwise(0))
