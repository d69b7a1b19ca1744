"""Matching of work mentions to works, by identifiers first and titles then."""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quillstone.functions import titles
from quillstone.functions.text import title_key
from quillstone.operators.fixpoint import cut
from quillstone.operators.relational import unique_targets
from quillstone.operators.spread import pairs_between


@dataclass(frozen=True)
class WorkCuts:
    auto: float = 0.90
    review: float = 0.60


#: What identifiers decide.
EXTERNAL, CATALOGUE, OPUS = 0.99, 0.97, 0.92
CONFLICT, OPUS_CONFLICT, PLACE_CONFLICT = 0.05, 0.10, 0.15

#: Kinds of mentions up to which their matches are broadcast to the mentions; those of more are shuffled.
BROADCAST_KINDS = 20_000

FEATURES = "struct<core:string,kind:string,opus:string,number:int,key:string,ids:array<string>,externals:array<string>,derivation:string,parents:array<string>>"


def features(title: Column, surname: Column, externals: Column) -> Column:
    """The struct FEATURES of a title. Title folding runs batch-wise in Python, all else in the JVM [STR-10].

    The catalogue numbers in a derived work's title are its parent's, not its own.
    """
    numbers, derived, none = titles.catalogue_ids(title, surname), titles.derivation(title).isNotNull(), F.array().cast("array<string>")
    return F.struct(
        titles.core_title(title_key(title)).alias("core"), titles.work_type(title).alias("kind"), titles.opus(title).alias("opus"),
        titles.number_in_opus(title).alias("number"), titles.musical_key(title).alias("key"),
        F.when(derived, none).otherwise(numbers).alias("ids"), externals.alias("externals"), titles.derivation(title).alias("derivation"),
        F.when(derived, numbers).otherwise(none).alias("parents"),
    )


@F.pandas_udf(DoubleType())
def title_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity [STR-30]; each distinct pair of a batch is compared once."""
    seen: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(a, b):
        if pair not in seen:
            seen[pair] = SequenceMatcher(None, *pair).ratio()
        out.append(seen[pair])
    return pd.Series(out, dtype="float64")


def length_bound(a: Column, b: Column) -> Column:
    """No ratio exceeds what the shorter title's length allows."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.least(F.length(a), F.length(b)) / total)


def _scheme(i: Column) -> Column:
    return F.split_part(i, F.lit(":"), F.lit(1))


def _numbered_apart(x: Column, y: Column) -> Column:
    """Whether some scheme numbers both sides and no number of it is the same."""
    ours, theirs = (F.array_distinct(F.transform(i, _scheme)) for i in (x, y))
    both = F.array_intersect(ours, theirs)
    return F.exists(both, lambda s: ~F.arrays_overlap(F.filter(x, lambda i: _scheme(i) == s), F.filter(y, lambda i: _scheme(i) == s)))


def identifier_score(a: Column, b: Column) -> Column:
    """The score that identifiers settle, or null [LNK-21]. Two derived works with numbers of different parents differ."""
    x, y = (F.concat(f["ids"], f["externals"]) for f in (a, b))
    return (
        F.when(~a["derivation"].eqNullSafe(b["derivation"]), CONFLICT)
        .when(a["derivation"].isNotNull(), F.when(_numbered_apart(a["parents"], b["parents"]), CONFLICT))
        .when(F.arrays_overlap(a["externals"], b["externals"]), EXTERNAL)
        .when(F.arrays_overlap(x, y), CATALOGUE)
        .when(_numbered_apart(x, y), CONFLICT)
        .when(a["opus"] != b["opus"], OPUS_CONFLICT)
        .when((a["opus"] == b["opus"]) & (a["number"] != b["number"]), PLACE_CONFLICT)
        .when(a["opus"] == b["opus"], OPUS)
    )


def title_score(a: Column, b: Column, ratio: Column) -> Column:
    """The title's score, sharpened by number, key and kind [LNK-22]. Grows with ratio, so a bound of one bounds the other."""
    other = lambda f: F.coalesce(a[f] != b[f], F.lit(False))
    same = lambda f: F.coalesce(a[f] == b[f], F.lit(False)).cast("int")
    out = ratio * F.when(other("number"), 0.5).otherwise(1.0) * F.when(other("key"), 0.7).otherwise(1.0)
    return F.least(F.lit(1.0), out + 0.05 * (same("kind") + same("number") + same("key")))


def _kinds(rows: DataFrame, *least: str) -> DataFrame:
    """(composer, f, ...): what is alike in all features, once a composer, with the least of other columns."""
    rows = rows.filter("composer IS NOT NULL AND f IS NOT NULL").select("composer", "f", *least)
    return cut(rows.groupBy("composer", "f").agg(*[F.min(c).alias(c) for c in least]) if least else rows.distinct())


def _shared(f: Column) -> Column:
    """One of these two works have in common, if identifiers tell that they are the same."""
    none = F.array().cast("array<string>")
    ids = F.transform(F.concat(F.coalesce(f["ids"], none), F.coalesce(f["externals"], none)), lambda i: F.concat(F.lit("id "), i))
    return F.when(f["derivation"].isNull(), F.array_distinct(F.array_compact(F.concat(ids, F.array(F.concat(F.lit("opus "), f["opus"]))))))


def best_matches(mentions: DataFrame, works: DataFrame, cuts: WorkCuts = WorkCuts()) -> DataFrame:
    """mentions(id, composer, f) with status, score, work and candidate: the best work of the same composer [JON-15, LNK-23, LNK-24].

    works(work, ordinal, composer, f). Of equal scores the lowest ordinal wins, and a score of 0 never does. Mentions
    alike in all features are matched once, and of such works only the first is a candidate. Works meet mentions by an
    identifier or opus in common. Titles are compared only where identifiers may leave it open, that is at equal
    derivation and not an opus on both sides, and if their bound can reach the review cut: no lower score changes a
    decision. Where that cut is so low that unlike identifiers reach it, all kinds of a composer meet.
    """
    first = F.struct(F.col("ordinal").isNull().alias("last"), "ordinal", "work").alias("first")
    asked, have = _kinds(mentions), _kinds(works.withColumn("first", first), "first")
    f, a, b = F.col("f"), F.col("x.f"), F.col("y.f")
    if cuts.review <= max(CONFLICT, OPUS_CONFLICT, PLACE_CONFLICT):
        met = open_ = pairs_between(asked, have, ["composer"], "f")
    else:
        met = pairs_between(*[rows.withColumn("key", F.explode(_shared(f))) for rows in (asked, have)], ["composer", "key"], "f")
        side = F.when(f["derivation"].isNotNull(), F.concat(F.lit("of "), f["derivation"])).when(f["opus"].isNull(), "plain").otherwise("opus")
        other = F.when(side == "plain", F.array(F.lit("plain"), F.lit("opus"))).when(side == "opus", F.array(F.lit("plain"))).otherwise(F.array(side))
        open_ = pairs_between(asked.withColumn("key", F.explode(other)), have.withColumn("key", side), ["composer", "key"], "f")
    fixed = identifier_score(a, b)
    open_ = open_.filter((title_score(a, b, length_bound(a["core"], b["core"])) >= cuts.review) & fixed.isNull())
    rows = met.withColumn("score", fixed).unionByName(open_.withColumn("score", title_score(a, b, title_ratio(a["core"], b["core"]))))
    rows = rows.filter("score > 0").select("composer", F.col("x.f").alias("f"), F.struct((-F.col("score")).alias("score"), F.col("y.first").alias("first")).alias("_m"))
    best = rows.groupBy("composer", "f").agg(F.min("_m").alias("_m"))
    if asked.count() <= BROADCAST_KINDS:
        best = F.broadcast(best)
    out = mentions.join(best, ["composer", "f"], "left")
    score, work = -F.col("_m.score"), F.col("_m.first.work")
    status = F.when(score >= cuts.auto, "auto_matched").when(score >= cuts.review, "needs_review").otherwise("created")
    return out.select(
        *mentions.columns, status.alias("status"), F.when(score >= cuts.review, score).alias("score"),
        F.when(score >= cuts.auto, work).alias("work"), F.when(score >= cuts.review, work).alias("candidate"),
    )


def _py_apart(x: set[str], y: set[str]) -> bool:
    of = lambda ids, scheme: {i for i in ids if i.split(":")[0] == scheme}
    schemes = {i.split(":")[0] for i in x} & {i.split(":")[0] for i in y}
    return any(of(x, s).isdisjoint(of(y, s)) for s in schemes)


def _py_identifier(a: dict, b: dict) -> float | None:
    """identifier_score() of two dicts."""
    if a["derivation"] != b["derivation"]:
        return CONFLICT
    if a["derivation"]:
        return CONFLICT if _py_apart({*a["parents"]}, {*b["parents"]}) else None
    x, y = {*a["ids"], *a["externals"]}, {*b["ids"], *b["externals"]}
    if {*a["externals"]} & {*b["externals"]}:
        return EXTERNAL
    if x & y:
        return CATALOGUE
    if _py_apart(x, y):
        return CONFLICT
    if a["opus"] and b["opus"]:
        if a["opus"] != b["opus"]:
            return OPUS_CONFLICT
        return PLACE_CONFLICT if a["number"] and b["number"] and a["number"] != b["number"] else OPUS
    return None


def _py_title(a: dict, b: dict, ratio: float) -> float:
    pairs = [(a[f], b[f]) for f in ("number", "key", "kind")]
    for (x, y), factor in zip(pairs, (0.5, 0.7, 1.0)):
        ratio *= factor if x and y and x != y else 1.0
    return min(1.0, ratio + 0.05 * sum(bool(x) and x == y for x, y in pairs))


def resolve_in_order(mentions: DataFrame, cuts: WorkCuts = WorkCuts()) -> DataFrame:
    """(id, status, score, work): mentions(id, composer, place, f) matched one after the other [LNK-25].

    A mention that matches nothing becomes a work, and so a candidate of the next: the order matters within a composer,
    whose mentions one task therefore takes in `place` order. Exact title keys are settled by a dictionary, and a title
    is compared only while its characters in common allow a better score, so that a task does far less than all pairs.
    Ids are made of composer, first identifier or title, and place, and so are the same in each run.
    """

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        known: list[tuple[str, dict, Counter]] = []
        out = []
        for r in rows.sort_values("place").itertuples():
            f = {k: (v.tolist() if hasattr(v, "tolist") else v) for k, v in (r.f if isinstance(r.f, dict) else r.f.asDict()).items()}
            f["number"] = None if pd.isna(f["number"]) else f["number"]
            best, at, chars = 0.0, None, Counter(f["core"])
            for k, (_, other, signs) in enumerate(known):
                score = _py_identifier(f, other)
                if score is None:
                    total = len(f["core"]) + len(other["core"])
                    bound = 2 * (chars & signs).total() / total if total else 1.0
                    if _py_title(f, other, bound) <= best:
                        continue
                    score = _py_title(f, other, SequenceMatcher(None, f["core"], other["core"]).ratio())
                if score > best:
                    best, at = score, k
            status = "auto_matched" if best >= cuts.auto else "needs_review" if best >= cuts.review else "created"
            work = known[at][0] if status == "auto_matched" else None
            if status == "created":
                name = (sorted(f["ids"]) or [f["core"]])[0]
                work = hashlib.sha256(f"{r.composer}\0{name}\0{r.place}".encode()).hexdigest()[:32]
                known.append((work, f, chars))
            out.append((r.id, status, best if status != "created" else None, work))
        return pd.DataFrame(out, columns=["id", "status", "score", "work"])

    return mentions.groupBy("composer").applyInPandas(one, "id long, status string, score double, work string")


def enclosing_sets(works: DataFrame) -> DataFrame:
    """(work, parent): a numbered work's smallest range that holds its number [LNK-28, JON-14]. works(work, scheme, low, high)"""
    ranges = works.filter("high > low")
    members = ranges.select("scheme", F.explode(F.sequence("low", "high")).alias("number"), F.col("work").alias("parent"), (F.col("high") - F.col("low")).alias("width"))
    # One row a number before works meet it: what a number's smallest range is does not hang on who asks.
    best = members.groupBy("scheme", "number").agg(F.min(F.struct("width", "parent")).alias("_best"))
    single = works.filter("high = low").select("work", "scheme", F.col("low").alias("number"))
    return single.join(best, ["scheme", "number"]).groupBy("work").agg(F.min("_best").alias("_best")).select("work", F.col("_best.parent").alias("parent"))


def catalogue_parents(derived: DataFrame, identifiers: DataFrame) -> DataFrame:
    """(work, parent): a derived work's parent, where one work alone holds the parent's number [LNK-28]."""
    return derived.join(unique_targets(identifiers, "value", "parent"), "value").filter("work <> parent").select("work", "parent")


def scheme_owners(identifiers: DataFrame) -> DataFrame:
    """(scheme, owner): the composer of more than half of a scheme's numbers [LNK-26]. identifiers(scheme, value, composer)"""
    counts = identifiers.filter("composer IS NOT NULL").groupBy("scheme", "composer").agg(F.countDistinct("value").alias("n"))
    total = identifiers.groupBy("scheme").agg(F.countDistinct("value").alias("all"))
    return counts.join(total, "scheme").filter(F.col("n") * 2 > F.col("all")).select("scheme", F.col("composer").alias("owner"))


def merge_application(rows: DataFrame, merged: DataFrame, column: str, key: list[str]) -> DataFrame:
    """rows re-pointed by merged(old, new), equal keys once [LNK-27, SET-05]."""
    out = rows.join(merged.select(F.col("old").alias(column), "new"), column, "left")
    return out.withColumn(column, F.coalesce("new", column)).select(*rows.columns).dropDuplicates(key)


def work_entities(records: DataFrame, mentions: DataFrame) -> DataFrame:
    """(work, entity, source) of the work entities whose records a work's mentions were read from, each once [LNK-29, JON-11].

    records(source, external_id, entity), mentions(source, external_id, work): what follows '#' in a mention's id is its
    place in the record.
    """
    own = F.split_part("external_id", F.lit("#"), F.lit(1))
    rows = mentions.filter("work IS NOT NULL").select("source", own.alias("external_id"), "work")
    return rows.join(records.filter("entity IS NOT NULL"), ["source", "external_id"]).select("work", "entity", "source").distinct()
