"""Operator 2, document fingerprints: one-permutation MinHash with optimal densification, in b-bit form. JVM side only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import WHITESPACE, WORD_GAP

SHINGLE_WORDS = 5
BINS, LOW_BITS = 256, 4
#: Places of a long that hold a bin's low bits.
PER_LONG = 64 // LOW_BITS
_TOP = 56
_REST = (1 << _TOP) - 1
#: Probes written out one by one before the closed form, which is dearer, finds the first full bin.
PROBES = 12


def _constants(values: list[int], kind: str = "bigint") -> Column:
    """A literal array; the optimiser folds it once, however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _starts_and_steps() -> tuple[list[int], list[int], list[int]]:
    """For each bin, where its probing starts, its odd step, and the step's inverse modulo BINS."""
    state, starts, steps = 0x2545F491, [], []
    for _ in range(BINS):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        starts.append(state >> 40 & (BINS - 1))
        steps.append(state >> 50 & (BINS - 1) | 1)
    return starts, steps, [pow(s, -1, BINS) for s in steps]


def shingle_hashes(words: Column) -> Column:
    """Hashes of the five-word shingles of an array column of word hashes.

    One to four words are one shingle; no words are one that stands for emptiness.
    """
    at = F.sequence(F.lit(0), F.size(words) - SHINGLE_WORDS)
    full = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE_WORDS)]))
    return F.when(F.size(words) >= SHINGLE_WORDS, full).otherwise(F.array(F.xxhash64(words)))


def _empty(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_REST)) == F.lit(_REST)


def with_fingerprint(rows: DataFrame, text: str, out: str) -> DataFrame:
    """rows with out, the fingerprint of the text column: BINS values of LOW_BITS bits, packed in longs.

    Each shingle is hashed once: its hash's first byte is its bin, and a bin keeps its least hash. An empty bin goes
    through the bins in an order of its own, the same for all documents, and borrows from the first full one. Of each
    value the low bits are stored. Rows stay where they are, and each text's arrays are its own.
    """
    keep = rows.columns
    bare = F.trim(F.col(text), F.lit(WHITESPACE))
    words = F.when(F.length(bare) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(bare, WORD_GAP, -1), lambda w: F.xxhash64(w))
    )
    rows = rows.select(*keep, words.alias("_words"))
    # One mark a bin, larger than any hash in it: after sorting, a bin's first entry is its least hash or its mark.
    marks = _constants([(b << _TOP) | _REST for b in range(-BINS // 2, BINS // 2)])
    rows = rows.select(*keep, F.sort_array(F.concat(shingle_hashes(F.col("_words")), marks)).alias("_sorted"))

    def opens(x: Column, i: Column) -> Column:
        before = F.get("_sorted", i - 1)
        return (i == 0) | (F.shiftright(x, _TOP) != F.shiftright(before, _TOP))

    rows = rows.select(*keep, F.filter("_sorted", opens).alias("_bins"))
    low = F.lit((1 << LOW_BITS) - 1)
    rows = rows.select(*keep, "_bins", F.filter("_bins", lambda x: ~_empty(x)).alias("_full"))
    starts, steps, inverses = (_constants(x, "int") for x in _starts_and_steps())

    def borrowed(i: Column) -> Column:
        start, step, inverse = F.get(starts, i), F.get(steps, i), F.get(inverses, i)

        def lent(x: Column) -> Column:
            """Hashed with the borrower's place: else bins that borrow from one bin would be equal by chance together."""
            return F.xxhash64(x.bitwiseAND(F.lit(_REST)), i).bitwiseAND(low)

        def probe(t: int) -> Column:
            x = F.get("_bins", (start + step * t).bitwiseAND(F.lit(BINS - 1)))
            return F.when(~_empty(x), lent(x))

        def turn(x: Column) -> Column:
            """When bin i would come to the full bin x, in place of x's own bin."""
            t = ((F.shiftright(x, _TOP) + BINS // 2 - start) * inverse).bitwiseAND(F.lit(BINS - 1).cast("long"))
            return F.shiftleft(t - BINS // 2, _TOP).bitwiseOR(x.bitwiseAND(F.lit(_REST)))

        return F.coalesce(*[probe(t) for t in range(PROBES)], lent(F.array_min(F.transform("_full", turn))))

    values = F.transform("_bins", lambda x, i: F.when(_empty(x), borrowed(i)).otherwise(x.bitwiseAND(low)))
    rows = rows.select(*keep, values.alias("_values"))

    def packed(k: int) -> Column:
        part = F.slice("_values", k * PER_LONG + 1, PER_LONG)
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, LOW_BITS).bitwiseOR(x))

    return rows.select(*keep, F.array(*[packed(k) for k in range(BINS // PER_LONG)]).alias(out))


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two fingerprints: the share of equal values, less what chance makes equal."""

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for k in (2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, k))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    apart = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x).cast("double")
    chance = 1.0 / (1 << LOW_BITS)
    return F.greatest(F.lit(0.0), (1 - apart / BINS - chance) / (1 - chance))


@dataclass(frozen=True)
class NextRules:
    """Documents are put in order in ranges of about range_rows, max_ranges at most."""

    range_rows: int = 2000
    max_ranges: int = 1 << 14


def with_next(rows: DataFrame, names: dict[str, str], rules: NextRules = NextRules()) -> DataFrame:
    """rows(doc_id, ...) with, under new names, columns of the row that follows by doc_id; the first follows the last.

    Ranges of doc_id start at quantiles, which are ids themselves; the rows of a range's first id also go, as copies,
    to the range before, whose last row needs them. So each row is shuffled once, and no task holds more than a range.
    Rows of equal doc_id go by the hash of their text; null ids come last.
    """
    n = rows.select("doc_id").count()
    ranges = max(1, min(rules.max_ranges, -(-n // rules.range_rows)))
    quantiles = F.percentile_approx("doc_id", [k / ranges for k in range(ranges)], 10 * ranges + 1000)
    found = rows.agg(quantiles.alias("q")).first().q
    firsts = sorted({x for x in found or [] if x is not None})
    at = F.lit(1)
    is_first = F.lit(not firsts)
    if firsts:
        starts, size = _constants(firsts), len(firsts)
        bits = [1 << k for k in reversed(range(size.bit_length()))]

        def further(place: Column, bit: Column) -> Column:
            step = place + bit
            return F.when((step <= size) & (F.get(starts, step - 1) <= F.col("doc_id")), step).otherwise(place)

        place = F.aggregate(F.array(*[F.lit(b) for b in bits]), F.lit(0), further)
        at = F.when(F.col("doc_id").isNull(), F.lit(size)).otherwise(place)
        is_first = F.coalesce(F.get(starts, F.col("_at") - 1) == F.col("doc_id"), F.lit(False))
    last = max(1, len(firsts))
    rows = rows.withColumn("_at", at)
    before = F.when(F.col("_at") == 1, F.lit(last)).otherwise(F.col("_at") - 1)
    rows = rows.withColumn("_to", F.explode(F.when(is_first, F.array("_at", -before)).otherwise(F.array("_at"))))
    order = Window.partitionBy(F.abs("_to")).orderBy((F.col("_to") < 0).cast("int"), F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    rows = rows.withColumns({new: F.lead(old).over(order) for old, new in names.items()})
    return rows.filter("_to > 0").drop("_at", "_to")


def fingerprints(docs: DataFrame, edit: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """One row a row of docs(doc_id, text): fingerprints of the text and of edit(text, next text), and likenesses.

    Null texts count as empty, and texts without words are alike; rows of equal doc_id are put in order by text, and
    equal rows are each other's next; null ids come last; a lone row is its own next; an empty table gives an empty
    one; other columns are ignored.
    """
    edit = edit or replace_last_quarter
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_fingerprint(rows, "text", "_own"), {"text": "_next_text", "_own": "_next"})
    rows = rows.select("doc_id", "text", "_own", "_next", edit(F.col("text"), F.col("_next_text")).alias("_edited_text"))
    rows = with_fingerprint(rows, "_edited_text", "_edited")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("_edited_text", 256).alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )


def replace_last_quarter(text: Column, following: Column) -> Column:
    """The last quarter of the code points, rounded down, replaced by the first as many of the following text."""
    n = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - n), F.substring(following, F.lit(1), n))
