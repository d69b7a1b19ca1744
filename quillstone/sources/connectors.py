"""Parsers of stored source bodies: JSON and HTML text in, typed rows out. Fetching is not this engine's business."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import plain_text, truncate_time

# --- Query-service bindings [CON-04, CON-05, CON-06, CON-08, CON-09, CON-10] ---

_BINDINGS = "results struct<bindings: array<map<string, struct<type:string, value:string>>>>"


def bindings(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(b): one map of variable to value a result row of each body; broken bodies give none."""
    rows = bodies.select(F.explode(F.from_json(F.col(body), _BINDINGS)["results"]["bindings"]).alias("m"))
    return rows.select(F.transform_values("m", lambda _, v: v["value"]).alias("b"))


def entity_of(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(uri, r"(Q\d+)$", 1), F.lit(""))


def fold_items(rows: DataFrame, item: str, sets: list[str], dates: list[str], label: str) -> DataFrame:
    """One row an item: label, the sorted distinct values of each field, and of each date the earliest, to its precision."""
    b = F.col("b")
    got = lambda k: F.try_element_at(b, F.lit(k))
    out = [F.min(got(label)).alias("label")]
    out += [F.array_sort(F.collect_set(F.coalesce(entity_of(got(s)), got(s)))).alias(s) for s in sets]
    out += [F.min(truncate_time(got(d), got(f"{d}Precision").try_cast("int"))).alias(d) for d in dates]
    return rows.withColumn("qid", entity_of(got(item))).filter("qid IS NOT NULL").groupBy("qid").agg(*out)


def lat_lon(point: Column) -> Column:
    """'Point(lon lat)' as 'lat,lon'; null for anything else."""
    pattern = r"(?i)^\s*POINT\s*\(\s*(-?[\d.]+)\s+(-?[\d.]+)\s*\)\s*$"
    return F.when(point.rlike(pattern), F.concat_ws(",", F.regexp_extract(point, pattern, 2), F.regexp_extract(point, pattern, 1)))


def coverage_floor(found: DataFrame, known: int, share: float = 0.5) -> DataFrame:
    """found, or an error when it holds less than a share of what was known: a source that shrinks so is broken [CON-08]."""
    total = found.agg(F.count("*").alias("_n"))
    enough = F.when(F.col("_n") < known * share, F.raise_error(F.lit("too few rows"))).otherwise(F.lit(True))
    return found.join(total.select(enough.cast("boolean").alias("_ok")), F.lit(True)).filter("_ok").drop("_ok")


def counterparts(nodes: DataFrame, differs: DataFrame) -> DataFrame:
    """(qid, parent) of nodes(qid, label) that lack one: an item they are said to differ from, but that has their name [CON-07].

    differs(qid, other): names are equal but for case, or the other's has 'music' after it.
    """
    name = lambda c: F.lower(F.trim(c))
    others = nodes.select(F.col("qid").alias("other"), name(F.col("label")).alias("_named"))
    rows = nodes.select("qid", name(F.col("label")).alias("_own")).join(differs.distinct(), "qid").join(others, "other")
    same = (F.col("_named") == F.col("_own")) | (F.col("_named") == F.concat("_own", F.lit(" music")))
    return rows.filter(same & (F.col("qid") != F.col("other"))).select("qid", F.col("other").alias("parent"))


# --- People and works dumps [CON-01, CON-02, CON-11, CON-12, CON-14] ---


def people_list(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(name, url) of a paged list of category pages: an object of numbered entries, the rest of it metadata."""
    entries = F.from_json(F.col(body), "map<string, struct<id:string, type:string, permlink:string>>")
    rows = bodies.select(F.explode(entries).alias("k", "e")).filter(F.col("k").rlike(r"^\d+$") & F.col("e.id").isNotNull())
    return rows.select(F.regexp_replace("e.id", "^Category:", "").alias("name"), F.col("e.permlink").alias("url"))


_DUMP = """composers array<struct<name:string, complete_name:string, birth:string, death:string, epoch:string,
works: array<struct<title:string, subtitle:string, genre:string>>>>"""


def unpadded(date: Column) -> Column:
    """A year that was padded to its first of January, as a year."""
    return F.regexp_replace(date, r"^(\d{4})-01-01$", "$1")


def nested_dump(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(composer, birth, death, epoch, title, genre): a composer without works has one row with no title."""
    rows = bodies.select(F.explode(F.from_json(F.col(body), _DUMP)["composers"]).alias("c"))
    rows = rows.select("c.*").select("complete_name", "birth", "death", "epoch", F.explode_outer("works").alias("w"))
    title = F.concat_ws(", ", F.nullif(F.col("w.title"), F.lit("")), F.nullif(F.col("w.subtitle"), F.lit("")))
    return rows.select(
        F.col("complete_name").alias("composer"), unpadded(F.col("birth")).alias("birth"), unpadded(F.col("death")).alias("death"), "epoch",
        F.nullif(title, F.lit("")).alias("title"), F.col("w.genre").alias("genre"),
    )


def life_years(text: Column) -> Column:
    """struct<birth, death> of '(1770-1827)', '1770 – ' or 'b. 1955'."""
    got = lambda p: F.nullif(F.regexp_extract(text, p, 1), F.lit("")).cast("int")
    birth = F.coalesce(got(r"(\d{4})\s*[-–—]"), got(r"(?i)\b(?:b\.|born|\*)\s*(\d{4})"))
    return F.struct(birth.alias("birth"), F.coalesce(got(r"\d{4}\s*[-–—]\s*(\d{4})"), got(r"(?i)\b(?:d\.|died|†)\s*(\d{4})")).alias("death"))


# --- Concert archives [CON-15..19] ---

_PROGRAMS = """programs array<struct<id:string, programID:string, season:string,
concerts: array<struct<eventType:string, Location:string, Venue:string, Date:string>>,
works: array<struct<ID:string, composerName:string, workTitle:string, conductorName:string,
soloists: array<struct<soloistName:string, soloistInstrument:string>>>>>>"""


def programmes(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row a programme, concert and work of it [CON-17]."""
    rows = bodies.select(F.explode(F.from_json(F.col(body), _PROGRAMS)["programs"]).alias("p"))
    rows = rows.select("p.programID", "p.season", "p.works", F.explode("p.concerts").alias("c"))
    rows = rows.select("programID", "season", "c", F.explode("works").alias("w")).filter("w.workTitle IS NOT NULL")
    people = F.transform(F.col("w.soloists"), lambda s: F.struct(s["soloistName"].alias("name"), s["soloistInstrument"].alias("discipline")))
    return rows.select(
        "programID", "season", F.substring("c.Date", 1, 10).alias("date"), F.col("c.Venue").alias("venue"), F.col("c.eventType").alias("event_type"),
        F.col("w.composerName").alias("composer"), F.col("w.workTitle").alias("title"), F.col("w.conductorName").alias("conductor"), people.alias("soloists"),
    )


def registry(rows: DataFrame) -> DataFrame:
    """(role, name, programs, first, last, disciplines) of programmes()'s people [AGG-27, CON-16, CON-17]."""
    leaders = rows.select(F.lit("conductor").alias("role"), F.col("conductor").alias("name"), "programID", "season", F.lit(None).cast("string").alias("discipline"))
    solo = rows.select("programID", "season", F.explode("soloists").alias("s"))
    solo = solo.select(F.lit("soloist").alias("role"), F.col("s.name").alias("name"), "programID", "season", F.col("s.discipline").alias("discipline"))
    both = leaders.unionByName(solo).filter("name IS NOT NULL AND name <> ''").groupBy("role", "name")
    return both.agg(F.countDistinct("programID").alias("programs"), F.min("season").alias("first"), F.max("season").alias("last"), F.array_sort(F.collect_set("discipline")).alias("disciplines"))


def named_parts(text: Column) -> Column:
    """array<struct<name, discipline>> of 'Ann Lee (violin), Bo' [CON-15]."""
    parts = F.filter(F.transform(F.split(text, r"[,;](?![^(]*\))"), lambda x: F.trim(x)), lambda x: x != "")
    one = lambda x: F.struct(F.trim(F.regexp_replace(x, r"\s*\([^)]*\)\s*$", "")).alias("name"), F.nullif(F.regexp_extract(x, r"\(([^)]*)\)\s*$", 1), F.lit("")).alias("discipline"))
    return F.transform(parts, one)


def aligned(names: Column, titles: Column) -> Column:
    """Composers and works of a programme by place; a work without a composer goes on with the one before it [CON-19]."""
    both = F.arrays_zip(names.alias("c"), titles.alias("t"))
    none = F.array().cast("array<struct<composer:string,title:string>>")

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)["composer"]
        who = F.when(F.coalesce(x["c"], F.lit("")) != "", x["c"]).when(F.size(done) > 0, F.when(F.size(done) > 0, last))
        return F.array_append(done, F.struct(who.alias("composer"), x["t"].alias("title")))

    return F.filter(F.aggregate(F.transform(both, lambda x: F.struct(x["c"].alias("c"), x["t"].alias("t"))), none, add), lambda x: x["title"].isNotNull())


# --- HTML pages [CON-13, CON-20, CON-21, CON-24, CON-25, CON-26] ---


def table_rows(html: Column) -> Column:
    """array<array<string>>: the cells' text of every table row [STR-28]."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: plain_text(c))
    return F.filter(F.transform(rows, cells), lambda r: F.size(r) > 0)


def labelled_pairs(html: Column) -> Column:
    """map<string, string>: label and value of table rows, definition lists and bold labels; the first of equal labels."""
    found = []
    for pattern in (r"(?is)<th\b[^>]*>(.*?)</th>\s*<td\b[^>]*>(.*?)</td>", r"(?is)<dt\b[^>]*>(.*?)</dt>\s*<dd\b[^>]*>(.*?)</dd>", r"(?is)<(?:b|strong)>([^<]*?):?\s*</(?:b|strong)>:?\s*([^<]+)"):
        keys, values = (F.regexp_extract_all(html, F.lit(pattern), F.lit(k)) for k in (1, 2))
        clean = lambda x: F.regexp_replace(plain_text(x), r":\s*$", "")
        found.append(F.transform(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda p: F.struct(clean(p["k"]).alias("key"), plain_text(p["v"]).alias("value"))))
    pairs = F.filter(F.concat(*found), lambda p: p["key"] != "")
    names = F.transform(pairs, lambda p: p["key"])
    return F.map_from_entries(F.filter(pairs, lambda p, i: F.array_position(names, p["key"]) == i + 1))


def json_ld(html: Column) -> Column:
    """The first JSON-LD block of a page, as a variant; null if there is none, or it is broken [CON-20]."""
    return F.try_parse_json(F.nullif(F.regexp_extract(html, r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>", 1), F.lit("")))


def links(html: Column, pattern: str) -> Column:
    """Distinct link targets that match, in order: the frontier of a walk [CON-20, CON-21]."""
    return F.array_distinct(F.filter(F.regexp_extract_all(html, F.lit(r'(?i)\bhref="([^"#]*)'), F.lit(1)), lambda x: x.rlike(pattern)))


def frontier(found: DataFrame, seen: DataFrame) -> DataFrame:
    """(url): links that were not seen."""
    return found.select("url").distinct().join(seen.select("url"), "url", "left_anti")


# --- Catalogues of releases and scores [CON-03, CON-22, CON-23] ---

_PRODUCT = """id string, title string, label string, releaseDate string,
tracks array<struct<work:string, composer:string, title:string, credits: array<struct<name:string, role:string>>>>"""


def release_works(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(record_key, composer, title, tracks, artists): a release's tracks by work, people in order of credit [CON-22]."""
    product = F.from_json(F.col(body), _PRODUCT)
    rows = bodies.select(product.alias("p")).select(F.col("p.id").alias("record_key"), F.posexplode("p.tracks").alias("at", "t"))
    work = F.coalesce(F.col("t.work"), F.regexp_replace("t.title", r":.*$", ""))
    rows = rows.select("record_key", "at", F.col("t.composer").alias("composer"), work.alias("title"), "t.credits")
    people = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "credits"))), lambda x: F.coalesce(x["credits"], F.array().cast("array<struct<name:string,role:string>>")))))
    return rows.groupBy("record_key", "composer", "title").agg(F.count("*").alias("tracks"), people.alias("artists"))


def credit_line(text: Column) -> Column:
    """array<struct<name, role>> of 'Ann Lee, piano; Bo (conductor)' [CON-03, CON-23]."""
    parts = F.filter(F.transform(F.split(text, r"\s*[;|]\s*"), lambda x: F.trim(x)), lambda x: x != "")
    pattern = r"^(.*?)\s*(?:\(([^)]*)\)|,\s*([^,]*))?\s*$"
    role = lambda x: F.nullif(F.concat(F.regexp_extract(x, pattern, 2), F.regexp_extract(x, pattern, 3)), F.lit(""))
    return F.transform(parts, lambda x: F.struct(F.regexp_extract(x, pattern, 1).alias("name"), F.lower(role(x)).alias("role")))


SOURCES = {
    "bindings": bindings, "people_list": people_list, "nested_dump": nested_dump, "programmes": programmes, "release_works": release_works,
}
