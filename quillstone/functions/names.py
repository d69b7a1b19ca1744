"""Person names as arrays of readings: one label may be read in several ways [STR-03..05, STR-36, LNK-02]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import fold

#: Particles that belong to a surname, and suffixes that tell namesakes apart.
PARTICLES = ("van", "von", "de", "del", "della", "di", "du", "la", "le", "ter", "ten", "der")
SUFFIXES = ("i", "ii", "iii", "sr", "snr", "jr", "jun", "sen")

#: Agreement of given names, weakest first.
GIVEN_LEVELS = ("CONFLICT", "BOTH_SURNAME_ONLY", "ONE_SURNAME_ONLY", "INITIALS", "PREFIX", "EXACT")


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _literal(words: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _is_particle(w: Column) -> Column:
    return w.isin(*PARTICLES)


def _core(words: Column) -> Column:
    return F.filter(words, lambda w: ~_is_particle(w))


def _reading(kind: str, surname: Column, given: Column, wanted: Column) -> Column:
    return F.when(wanted, F.struct(F.lit(kind).alias("reading"), surname.alias("surname"), given.alias("given")))


def with_readings(rows: DataFrame, label: str, out: str = "readings") -> DataFrame:
    """rows with out: array<struct<reading, surname, given>>, the primary reading first.

    'Last, First', 'Last I. I.' and 'First Last' are told apart by the comma and by initials; particles next to the
    surname are no part of its key. A plain two-word name may also be surname-first (reordered), and a surname of
    several words may be spelled as one (collapsed). A generational suffix rules other readings out.
    """
    keep = rows.columns
    rows = rows.withColumn("_f", fold(F.col(label))).withColumn("_w", _words(F.col("_f")))
    comma = F.locate(",", F.col("_f"))
    rows = rows.withColumns(
        {
            "_comma": comma > 0,
            "_last": _words(F.substring("_f", F.lit(1), comma - 1)),
            "_first": _words(F.substring("_f", comma + 1, F.length("_f"))),
        }
    )
    w, n = F.col("_w"), F.size("_w")
    rows = rows.withColumn("_led", ~F.col("_comma") & (n > 1) & F.forall(F.slice(w, 2, F.greatest(n, F.lit(1))), lambda x: F.length(x) == 1))
    # In a plain name, the run of particles before the last word starts at _cut (counted from 0).
    body = F.slice(w, 1, F.greatest(n - 1, F.lit(0)))
    after = F.aggregate(body, F.lit(0), lambda run, x: F.when(_is_particle(x), run + 1).otherwise(0))
    lead = F.aggregate(
        w, F.struct(F.lit(True).alias("on"), F.lit(0).alias("n")),
        lambda s, x: F.struct((s["on"] & _is_particle(x)).alias("on"), (s["n"] + (s["on"] & _is_particle(x)).cast("int")).alias("n")),
    )["n"]
    rows = rows.withColumn("_cut", F.greatest(n - 1 - after, F.lit(0))).withColumn("_lead", lead)
    cut = F.col("_cut")
    given = (
        F.when(F.col("_comma"), _core(F.col("_first")))
        .when(F.col("_led"), F.slice(w, 2, F.greatest(n, F.lit(1))))
        .otherwise(_core(F.slice(w, 1, cut)))
    )
    surname = (
        F.when(F.col("_comma"), F.array_join(_core(F.col("_last")), " "))
        .when(F.col("_led"), F.get(w, F.lit(0)))
        .otherwise(F.coalesce(F.get(w, n - 1), F.lit("")))
    )
    rows = rows.withColumn("_given", given).withColumn("_surname", surname)
    plain = ~F.col("_comma") & ~F.col("_led")
    after_lead = F.get(w, F.col("_lead") + 1)
    turned = plain & (n - F.col("_lead") == 2) & (F.length(F.get(w, F.col("_lead"))) >= 2) & ~_is_particle(after_lead)
    parts = n - 1 - cut
    glued = F.when(F.col("_comma"), F.col("_last")).when(parts > 0, F.slice(w, cut + 1, F.greatest(n, F.lit(1))))
    glued = glued.when(F.size("_given") >= 2, F.slice(w, F.greatest(cut, F.lit(1)), F.greatest(n, F.lit(1))))
    less = F.when(plain & (parts == 0), F.slice("_given", 1, F.greatest(F.size("_given") - 1, F.lit(0)))).otherwise(F.col("_given"))
    other = ~F.arrays_overlap(w, _literal(SUFFIXES))
    readings = F.array(
        _reading("primary", F.col("_surname"), F.col("_given"), F.lit(True)),
        _reading("reordered", F.get(w, F.col("_lead")), F.array(after_lead), other & turned & (F.get(w, F.col("_lead")) != F.col("_surname"))),
        _reading("collapsed", F.array_join(glued, ""), less, other & ~F.col("_led") & (F.size(glued) >= 2) & (F.array_join(glued, "") != F.col("_surname"))),
    )
    return rows.select(*keep, F.filter(readings, lambda r: r.isNotNull()).alias(out))


def comparable(a: Column, b: Column) -> Column:
    """Surnames agree; a surname-first reading needs an equal first given name, and never meets another one."""
    guesses = (a["reading"] == "reordered").cast("int") + (b["reading"] == "reordered").cast("int")
    first = F.get(a["given"], F.lit(0)) == F.get(b["given"], F.lit(0))
    return (a["surname"] != "") & (a["surname"] == b["surname"]) & ((guesses == 0) | ((guesses == 1) & F.coalesce(first, F.lit(False))))


def given_level(a: Column, b: Column) -> Column:
    """Index into GIVEN_LEVELS of two arrays of given names, compared place by place."""
    n = F.least(F.size(a), F.size(b))

    def agree(x: Column, y: Column) -> Column:
        """2 equal, 1 one abbreviates the other (in one or two letters), 0 neither; null beyond the shorter name."""
        short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
        return F.when(x.isNull() | y.isNull(), None).when(x == y, 2).when((F.length(short) <= 2) & F.startswith(long, short), 1).otherwise(0)

    worst = F.coalesce(F.array_min(F.zip_with(a, b, agree)), F.lit(2))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1).when(n == 0, 2).when(worst == 0, 0).when(worst == 1, 3)
        .when(F.size(a) != F.size(b), 4).otherwise(5)
    )


def block_keys(readings: Column) -> Column:
    """array<struct<key, anchored>>: the surname of every reading but the reordered, and surname|first given of all.

    anchored: the surname stands where it was written; of equal keys the anchored one counts.
    """
    anchored = lambda r: r["reading"] != "reordered"
    bare = F.transform(F.filter(readings, lambda r: anchored(r) & (r["surname"] != "")), lambda r: F.struct(r["surname"].alias("key"), F.lit(True).alias("anchored")))
    full = F.transform(
        F.filter(readings, lambda r: (F.size(r["given"]) > 0) & (r["surname"] != "")),
        lambda r: F.struct(F.concat_ws("|", r["surname"], F.get(r["given"], F.lit(0))).alias("key"), anchored(r).alias("anchored")),
    )
    return F.array_distinct(F.concat(bare, full))
