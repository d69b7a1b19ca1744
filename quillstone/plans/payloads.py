"""Names, titles, payloads and source parsers, over texts made of the driver's tables, whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.functions import instruments, names, payloads, titles
from quillstone.functions import text as X
from quillstone.operators import anchoring, events, export, works
from quillstone.plans.views import table
from quillstone.sources import connectors

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def _part(spark: SparkSession, d: str) -> DataFrame:
    """Parts with their name's two words: a stands for a given name, s for a surname; m is the key modulo 6."""
    rows = table(spark, d, "part").withColumn("m", F.col("p_partkey") % 6)
    return rows.withColumns({"a": F.split_part("p_name", F.lit(" "), F.lit(1)), "s": F.split_part("p_name", F.lit(" "), F.lit(2))})


_P = "p AS (SELECT *, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS s, p_partkey % 6 AS m FROM part)"


def _cases(column: str, *values) -> Column:
    """The value at the place that column gives."""
    out = values[-1] if not isinstance(values[-1], str) else F.lit(values[-1])
    for k in reversed(range(len(values) - 1)):
        out = F.when(F.col(column) == k, values[k]).otherwise(out)
    return out


def _label(spark: SparkSession, d: str) -> DataFrame:
    """Six ways to write a name: Last, First; First Last; Last I.; First von Last; Last alone; First Middle Last."""
    p = _part(spark, d)
    label = _cases(
        "m", F.concat("s", F.lit(", "), "a"), F.col("p_name"), F.concat("s", F.lit(" "), F.substring("a", 1, 1), F.lit(".")),
        F.concat("a", F.lit(" von "), "s"), F.col("s"), F.concat("a", F.lit(" Ébert "), "s"),
    )
    return names.with_readings(p.withColumn("label", label), "label")


@query(f"""WITH {_P} SELECT p_partkey, s AS surname, CASE m WHEN 2 THEN substr(a, 1, 1) WHEN 4 THEN '' WHEN 5 THEN a || ' ebert' ELSE a END AS given,
CASE m WHEN 1 THEN 'primary,reordered' WHEN 3 THEN 'primary,collapsed' WHEN 5 THEN 'primary,collapsed' ELSE 'primary' END AS readings FROM p""")
def str03_name_readings(spark: SparkSession, d: str) -> DataFrame:
    first = F.get("readings", F.lit(0))
    kinds = F.array_join(F.transform("readings", lambda r: r["reading"]), ",")
    return _label(spark, d).select("p_partkey", first["surname"].alias("surname"), F.array_join(first["given"], " ").alias("given"), kinds.alias("readings"))


def _reading(kind: Column, surname: Column, *given: Column) -> Column:
    return F.struct(kind.alias("reading"), surname.alias("surname"), F.array(*given).cast("array<string>").alias("given"))


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 3 THEN false ELSE true END AS alike, m IN (0, 2) AS guessed, false AS both_guessed FROM p""")
def str04_comparable(spark: SparkSession, d: str) -> DataFrame:
    """Surnames must agree; a guessed reading needs an equal first given name; two guesses never meet."""
    p = _part(spark, d)
    primary, turned = F.lit("primary"), F.lit("reordered")
    other = F.when(F.col("m") == 3, F.concat("s", F.lit("x"))).otherwise(F.col("s"))
    given = F.when(F.col("m").isin(0, 2), F.col("a")).otherwise(F.concat("a", F.lit("z")))
    one = _reading(primary, F.col("s"), F.col("a"))
    return p.select(
        "p_partkey", names.comparable(one, _reading(primary, other, F.lit("q"))).alias("alike"),
        names.comparable(one, _reading(turned, F.col("s"), given)).alias("guessed"),
        names.comparable(_reading(turned, F.col("s"), F.col("a")), _reading(turned, F.col("s"), F.col("a"))).alias("both_guessed"),
    )


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 0 THEN 'EXACT' WHEN 1 THEN 'PREFIX' WHEN 2 THEN 'INITIALS' WHEN 3 THEN 'ONE_SURNAME_ONLY'
WHEN 4 THEN 'CONFLICT' ELSE 'BOTH_SURNAME_ONLY' END AS level FROM p""")
def str05_given_level(spark: SparkSession, d: str) -> DataFrame:
    p = _part(spark, d)
    one = F.when(F.col("m") == 5, F.array().cast("array<string>")).otherwise(F.array("a"))
    none = F.array().cast("array<string>")
    two = _cases("m", F.array("a"), F.array("a", "s"), F.array(F.substring("a", 1, 1)), none, F.array(F.concat(F.lit("zz"), "a")), none)
    level = F.element_at(F.array(*[F.lit(x) for x in names.GIVEN_LEVELS]), names.given_level(one, two) + 1)
    return p.select("p_partkey", level.alias("level"))


@query(f"""WITH {_P} SELECT p_partkey, array_to_string(list_sort(CASE m WHEN 1 THEN [s || ':true', s || '|' || a || ':true', a || '|' || s || ':false']
WHEN 2 THEN [s || ':true', s || '|' || substr(a, 1, 1) || ':true'] WHEN 3 THEN [s || ':true', s || '|' || a || ':true', 'von' || s || ':true', 'von' || s || '|' || a || ':true']
WHEN 4 THEN [s || ':true'] WHEN 5 THEN [s || ':true', s || '|' || a || ':true', 'ebert' || s || ':true', 'ebert' || s || '|' || a || ':true']
ELSE [s || ':true', s || '|' || a || ':true'] END), ',') AS keys FROM p""")
def lnk02_block_keys(spark: SparkSession, d: str) -> DataFrame:
    keys = F.transform(names.block_keys(F.col("readings")), lambda k: F.concat(k["key"], F.lit(":"), k["anchored"].cast("string")))
    return _label(spark, d).select("p_partkey", F.array_join(F.array_sort(keys), ",").alias("keys"))


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 0 THEN a || ' ' || s || ' philharmonic' WHEN 1 THEN s || ' orchestra' ELSE a || ' orchestra' END AS key,
CASE WHEN m = 2 THEN a || ' orchester' END AS whole FROM p""")
def str07_ensemble_key(spark: SparkSession, d: str) -> DataFrame:
    p = _part(spark, d)
    name = F.when(F.col("m") == 0, F.concat(F.lit("The "), "p_name", F.lit(" Philharmonic Orchestra")))
    name = name.when(F.col("m") == 1, F.concat(F.lit("Das "), "s", F.lit("-Orchester"))).otherwise(F.concat("a", F.lit(" Orkest")))
    name = F.when(F.col("m") == 1, F.concat(F.lit("Das "), "s", F.lit(" Orchester"))).otherwise(name)
    part = F.when(F.col("m") == 2, F.concat(F.lit("Members of the "), "a", F.lit(" Orchester"))).otherwise(name)
    return p.select("p_partkey", anchoring.ensemble_key(name).alias("key"), anchoring.whole_of(part).alias("whole"))


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 0 THEN 'chamber' WHEN 1 THEN 'choir' WHEN 2 THEN 'orchestra' WHEN 3 THEN 'chamber' WHEN 4 THEN 'band' END AS kind FROM p""")
def str09_ensemble_type(spark: SparkSession, d: str) -> DataFrame:
    """The first kind in order of precedence: a quartet of an orchestra is chamber music."""
    suffix = _cases("m", " Quartet", " Chorus", " Philharmonic", " Orchestra Quartet", " Ensemble", "")
    return _part(spark, d).select("p_partkey", X.ensemble_type(F.concat("p_name", suffix)).alias("kind"))


def _title(p: DataFrame) -> DataFrame:
    n, k = F.col("p_size").cast("string"), (F.col("p_partkey") % 90 + 1).cast("string")
    title = _cases(
        "m", F.concat(F.lit("Symphony No. "), n, F.lit(" in C-sharp minor, Op. "), k), F.concat(F.lit("Sonate cis-Moll op. "), k, F.lit(" Nr. "), n),
        F.concat(F.lit("Concerto in B flat major, K. "), k), F.concat(F.lit("Partita BWV "), k, F.lit(" h-Moll")),
        F.concat("p_name", F.lit(" waltz, WoO "), k), F.concat(F.lit("Aria from "), "p_name", F.lit(", KV "), k),
    )
    return p.withColumn("title", title)


@query(f"""WITH {_P}, q AS (SELECT *, CAST(p_partkey % 90 + 1 AS VARCHAR) AS k FROM p) SELECT p_partkey, CASE WHEN m IN (0, 1) THEN k END AS opus, CASE WHEN m IN (0, 1) THEN p_size END AS number,
CASE m WHEN 0 THEN 'c sharp minor' WHEN 1 THEN 'c sharp minor' WHEN 2 THEN 'b flat major' WHEN 3 THEN 'b minor' END AS key,
CASE m WHEN 0 THEN 'symphony' WHEN 2 THEN 'concerto' WHEN 3 THEN 'partita' WHEN 4 THEN 'waltz' END AS kind,
CASE WHEN m = 2 THEN 'kv:' || k WHEN m = 4 THEN 'woo:' || k ELSE '' END AS ids, CASE WHEN m = 5 THEN 'kv:' || k ELSE '' END AS parents,
CASE WHEN m = 5 THEN 'excerpt' END AS derivation FROM q""")
def str10_title_features(spark: SparkSession, d: str) -> DataFrame:
    f = works.features(F.col("title"), F.lit("mozart"), F.array().cast("array<string>"))
    rows = _title(_part(spark, d)).select("p_partkey", f.alias("f"))
    flat = [F.col(f"f.{c}").alias(c) for c in ("opus", "number", "key", "kind", "derivation")]
    return rows.select("p_partkey", *flat, F.array_join("f.ids", ",").alias("ids"), F.array_join("f.parents", ",").alias("parents"))


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 0 THEN 'b minor' WHEN 1 THEN 'b flat major' WHEN 2 THEN 'e flat major' WHEN 3 THEN 'f sharp minor' WHEN 4 THEN 'a major' END AS key FROM p""")
def str11_musical_key(spark: SparkSession, d: str) -> DataFrame:
    key = _cases("m", "h-Moll", "B-Dur", "Es-Dur", "in F sharp minor", "A-Dur", "a minor key")
    return _part(spark, d).select("p_partkey", titles.musical_key(F.concat("p_name", F.lit(" "), key)).alias("key"))


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 0 THEN 'kv:' || p_size WHEN 1 THEN 'bwv:' || p_size || 'a' WHEN 2 THEN 'woo:' || p_size WHEN 3 THEN 'hob:xvi:' || p_size ELSE '' END AS ids FROM p""")
def str12_catalogue_ids(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size").cast("string")
    title = _cases("m", F.concat(F.lit("KV "), n), F.concat(F.lit("BWV "), n, F.lit("a")), F.concat(F.lit("WoO "), n), F.concat(F.lit("Hob. XVI:"), n), F.concat(F.lit("RV "), n), F.col("p_name"))
    surname = _cases("m", "mozart", "bach", "anyone", "haydn", "mozart", "bach")
    return _part(spark, d).select("p_partkey", F.array_join(titles.catalogue_ids(title, surname), ",").alias("ids"))


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 0 THEN 'kv:' || p_size WHEN 1 THEN 'bwv:' || p_size WHEN 2 THEN 'kv:' || p_size WHEN 3 THEN 'wd:Q9:x ' || p_size ELSE '' END AS ids FROM p""")
def str14_item_code(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size").cast("string")
    code = _cases("m", F.concat(F.lit("K. "), n), n, n, F.concat(F.lit("X- "), n), F.lit("deest"), F.lit("none"))
    item = _cases("m", "Q162478", "Q214203", "Q1", "Q9", "Q9", F.lit(None).cast("string"))
    short = F.when(F.col("m") == 2, "KV")
    return _part(spark, d).select("p_partkey", F.array_join(titles.item_code(code, item, short, F.lit("mozart")), ",").alias("ids"))


@query(f"""WITH {_P} SELECT p_partkey, m IN (0, 3, 4) AS mine, m IN (0, 4) AS alone FROM p""")
def str15_composer_catalogues(spark: SparkSession, d: str) -> DataFrame:
    """The same letters count for the composer whose they are alone; a scheme of anyone's for all."""
    n = F.col("p_size").cast("string")
    title = _cases("m", F.concat(F.lit("D. "), n), F.concat(F.lit("D. "), n), F.concat(F.lit("Sz. "), n), F.concat(F.lit("WoO "), n), F.concat(F.lit("RV "), n), F.col("p_name"))
    surname = _cases("m", "schubert", "liszt", "mozart", "ravel", "vivaldi", "vivaldi")
    ids = titles.catalogue_ids(title, surname)
    alone = F.exists(ids, lambda i: titles.is_composer_scoped(F.split_part(i, F.lit(":"), F.lit(1))))
    return _part(spark, d).select("p_partkey", (F.size(ids) > 0).alias("mine"), alone.alias("alone"))


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 0 THEN 'violin,piano' WHEN 1 THEN 'orchestra' WHEN 2 THEN 'string quartet' WHEN 3 THEN 'choir,organ' ELSE '' END AS categories FROM p""")
def str17_instrumentation(spark: SparkSession, d: str) -> DataFrame:
    said = _cases("m", "Violin and Piano", "full orchestra", "String Quartet", "SATB & Organ", F.concat(F.lit("violin and "), "p_name"), "violin, piano")
    return _part(spark, d).select("p_partkey", F.array_join(instruments.instrumentation(said), ",").alias("categories"))


@query(f"""WITH {_P} SELECT p_partkey, CASE WHEN m < 4 AND p_size % 10 > 0 THEN p_size % 10 END AS flutes, CASE WHEN m < 4 THEN 4 END AS horns,
CASE WHEN m < 4 AND m % 2 = 0 THEN 1 END AS timpani, CASE WHEN m < 4 THEN 1 END AS strings FROM p""")
def str18_shorthand(spark: SparkSession, d: str) -> DataFrame:
    """Four counts a section, and strings: without strings it is no orchestra."""
    winds = F.concat((F.col("p_size") % 10).cast("string"), F.lit(".2.2.3 - 4.3.3.1"))
    text = F.concat(winds, F.when(F.col("m") % 2 == 0, " - timp").otherwise(""), F.when(F.col("m") < 4, " - str").otherwise(""))
    found = instruments.shorthand(text)
    pick = lambda k, name: F.try_element_at(found, F.lit(k)).alias(name)
    return _part(spark, d).select("p_partkey", pick("flute", "flutes"), pick("horn", "horns"), pick("timpani", "timpani"), pick("strings", "strings"))


def _raw(p: DataFrame) -> DataFrame:
    """JSON payloads of six shapes: with a premiere or a broken one, ids, parts, and no JSON at all."""
    year = (F.col("p_size") + 1800).cast("string")
    f = lambda text, *args: F.format_string(text, *args)
    raw = _cases(
        "m", f('{"premiere": {"date": "%s-05-07", "place": " %s "}, "item": "http://x/Q%s", "part_of": ["Q3", "Q2", "x"]}', year, "p_name", "p_partkey"),
        f('{"premiere": {"date": "%s", "place": 5}, "iswc": "T-123.456.%s-1", "musicbrainz_work": ["4DAD1F72-0000-0000-0000-799131026480", "no"]}', year, F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")),
        f('{"premiere": {"date": "May %s"}, "instrumentation": {"parts": [{"label": "%s", "count": %s, "solo": true}, {"stated": "x", "count": true}, 7]}}', year, "p_name", "p_size"),
        f('{"premiere": "%s", "instrumentation": {"parts": [{"instrument": "", "count": 0, "solo": "yes"}]}}', year), F.lit("{broken"), F.lit("[1, 2]"),
    )
    source = F.when(F.col("m") < 2, "wikidata_catalogue").otherwise("imslp_works")
    return p.withColumns({"raw": raw, "source": source})


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 0 THEN (1800 + p_size) || '-05-07' WHEN 1 THEN CAST(1800 + p_size AS VARCHAR) END AS date, CASE WHEN m = 0 THEN p_name END AS place FROM p""")
def str20_premiere(spark: SparkSession, d: str) -> DataFrame:
    p = payloads.premiere_of(F.col("raw"))
    return _raw(_part(spark, d)).select("p_partkey", p["date"].alias("date"), p["place"].alias("place"))


@query(f"""WITH {_P} SELECT p_partkey, CASE m WHEN 0 THEN 'wikidata:Q' || p_partkey WHEN 1 THEN 'iswc:T123456' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || '1,musicbrainz:4dad1f72-0000-0000-0000-799131026480'
ELSE '' END AS ids, CASE WHEN m = 0 THEN 'Q2,Q3' ELSE '' END AS part_of FROM p""")
def jsn03_external_ids(spark: SparkSession, d: str) -> DataFrame:
    source, raw = F.col("source"), F.col("raw")
    return _raw(_part(spark, d)).select(
        "p_partkey", F.array_join(payloads.external_ids(source, raw), ",").alias("ids"), F.array_join(payloads.part_of(source, raw), ",").alias("part_of")
    )


@query(f"""WITH {_P}, q AS (SELECT p_partkey, unnest(CASE m WHEN 2 THEN [{{'stated': p_name, 'instrument': NULL, 'count': CAST(p_size AS BIGINT), 'solo': true}}, {{'stated': 'x', 'instrument': NULL, 'count': NULL, 'solo': false}}]
WHEN 3 THEN [{{'stated': NULL, 'instrument': NULL, 'count': NULL, 'solo': false}}] ELSE [] END) AS x FROM p)
SELECT p_partkey, x.stated AS stated, CAST(x.instrument AS VARCHAR) AS instrument, CAST(x.count AS BIGINT) AS count, x.solo AS solo FROM q""")
def jsn04_scoring_parts(spark: SparkSession, d: str) -> DataFrame:
    return _raw(_part(spark, d)).select("p_partkey", F.inline(payloads.scoring_parts(F.col("raw"))))


@query(f"""WITH {_P} SELECT p_partkey, CASE WHEN m < 3 THEN 'T' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') END AS code FROM p""")
def str26_recording_code(spark: SparkSession, d: str) -> DataFrame:
    n = F.lpad(F.col("p_partkey").cast("string"), 10, "0")
    dotted = F.concat(F.lit("t-"), F.substring(n, 1, 3), F.lit("."), F.substring(n, 4, 3), F.lit("."), F.substring(n, 7, 3), F.lit("-"), F.substring(n, 10, 1))
    return _part(spark, d).select("p_partkey", X.recording_code(F.when(F.col("m") < 3, dotted).otherwise(n)).alias("code"))


@query("""SELECT p_partkey, round(2.0 * length(p_name) / (2 * length(p_name) + 1 + length(p_type)), 9) AS ratio FROM part""")
def str30_title_ratio(spark: SparkSession, d: str) -> DataFrame:
    """A title against itself with more behind it: all of it is in common, whatever comes after."""
    p = _part(spark, d)
    return p.select("p_partkey", F.round(works.title_ratio(F.col("p_name"), F.concat_ws("#", "p_name", F.upper("p_type"))), 9).alias("ratio"))


@query(f"""WITH {_P} SELECT p_partkey, CASE WHEN m IN (0, 1) THEN 'Q' || p_partkey END AS id, CASE WHEN m IN (0, 2) THEN 'Q' || p_partkey END AS pinned FROM p""")
def str32_id_of_url(spark: SparkSession, d: str) -> DataFrame:
    q = F.concat(F.lit("Q"), "p_partkey")
    url = _cases("m", F.concat(F.lit("https://www.wikidata.org/wiki/"), q), F.concat(F.lit("http://www.wikidata.org/entity/"), q), F.concat(F.lit("https://example.org/wiki/"), q), F.lit(""))
    key = _cases("m", F.concat(F.lit("wikidata:"), q), F.concat(q, F.lit("|x")), F.concat(F.lit("ann|"), q), F.col("p_name"))
    return _part(spark, d).select("p_partkey", X.id_of_url(url).alias("id"), X.pinned_id(key).alias("pinned"))


@query(f"""WITH {_P} SELECT p_partkey, m IN (0, 1) AS scoped, m IN (0, 1, 2) AS sets, m IN (0, 1, 2, 5) AS catalogued FROM p""")
def str33_scheme_kinds(spark: SparkSession, d: str) -> DataFrame:
    scheme = _cases("m", "kv", "bwv", "woo", "iswc", "op", "wd")
    ids = F.array(F.concat(F.lit("op:"), "p_size"), F.concat(scheme, F.lit(":"), "p_size"))
    return _part(spark, d).select("p_partkey", titles.is_composer_scoped(scheme).alias("scoped"), titles.holds_sets(scheme).alias("sets"), titles.has_catalogue(ids).alias("catalogued"))


@query(f"""WITH {_P} SELECT p_partkey, array_to_string(list_distinct([x FOR x IN CASE WHEN length(a) <= 2 THEN string_split(a, '') ELSE [a] END]) || [s, 'j', 's'], ' ') AS tokens FROM p""")
def str36_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _part(spark, d).select("p_partkey", F.array_join(X.tokens(F.concat("a", F.lit("-"), F.initcap("s"), F.lit(", J. S."))), " ").alias("tokens"))


@query("""WITH f AS (SELECT l_partkey, l_suppkey, count(*) AS w FROM lineitem GROUP BY 1, 2), r AS (SELECT l_suppkey, count(DISTINCT l_orderkey) AS reach FROM lineitem GROUP BY 1)
SELECT l_partkey, l_suppkey, round(w / sqrt(reach), 9) AS affinity FROM f JOIN r USING (l_suppkey)""")
def mth03_affinity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem")
    reach = rows.groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("reach"))
    pairs = rows.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("w")).join(reach, "l_suppkey")
    return pairs.select("l_partkey", "l_suppkey", F.round(X.affinity(F.col("w"), F.col("reach")), 9).alias("affinity"))


@query("""SELECT p_partkey, round(p_size / sqrt(CAST(p_size AS DOUBLE) * (p_partkey % 7)), 9) AS cosine FROM part WHERE p_partkey % 7 > 0 UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey % 7 = 0""")
def mth04_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Null where one side has nothing to share."""
    return table(spark, d, "part").select("p_partkey", F.round(X.cosine(F.col("p_size"), F.col("p_size"), F.col("p_partkey") % 7), 9).alias("cosine"))


@query("""SELECT p_partkey, round_even(p_size / 8.0 / 0.25, 0) * 0.25 AS bits FROM part""")
def mth05_quarter_bits(spark: SparkSession, d: str) -> DataFrame:
    """Halves of a quarter go to the even one: sizes that are odd lie halfway."""
    return table(spark, d, "part").select("p_partkey", X.quarter_bits(F.col("p_size") / 8.0).alias("bits"))


@query(f"""WITH {_P}, q AS (SELECT p_partkey // 3 AS k, min(p_partkey) AS first FROM p GROUP BY 1) SELECT 'r' || k AS key, p_name AS name, 'soloist' AS role, 'piano' AS discipline FROM q JOIN part ON p_partkey = first
UNION ALL SELECT 'r' || k, 'Bo', 'performer', 'horn' FROM q""")
def jsn02_recordings(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of another kind, or without a key, are no recordings; people are those of all mentions, a name's first credit counts."""
    p = _part(spark, d)
    k = F.floor(F.col("p_partkey") / 3)
    head = F.first("p_name").over(Window.partitionBy(k).orderBy("p_partkey"))
    raw = F.format_string('{"_kind": "recording", "record_key": "r%s", "artists": [{"name": "%s", "role": "Soloist", "discipline": "piano"}, {"name": "Bo", "role": "guest", "discipline": "horn"}]}', k, head)
    good = p.select(F.col("p_partkey").alias("id"), F.lit("s").alias("source"), raw.alias("raw"))
    bad = p.select((-F.col("p_partkey") - 1).alias("id"), F.lit("s").alias("source"), F.lit('{"_kind": "concert", "record_key": "c"}').alias("raw"))
    return events.recordings(good.unionByName(bad))[1].select("key", "name", "role", "discipline")


@query("""WITH l AS (SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber FROM lineitem), c AS (SELECT 'o' || l_orderkey AS key, 'Sir ' || min(l_suppkey) AS name, 'conductor' AS role FROM l GROUP BY l_orderkey)
SELECT key, role, name FROM c UNION SELECT 'o' || l_orderkey, 'soloist', 'P' || l_partkey FROM l UNION SELECT 'o' || l_orderkey, 'ensemble', 'E' || (l_orderkey % 9) FROM l""")
def ing14_concert_credits(spark: SparkSession, d: str) -> DataFrame:
    """Conductors, soloists and ensembles of all mentions of a concert, each name once a role."""
    rows = table(spark, d, "lineitem")
    lead = rows.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("lead"))
    rows = rows.join(lead, "l_orderkey")
    raw = F.format_string('{"_kind": "concert", "concert_id": "o%s", "conductor": "Sir %s", "soloists": [{"name": "P%s", "discipline": "x"}], "ensembles": ["E%s"]}', "l_orderkey", "lead", "l_partkey", F.col("l_orderkey") % 9)
    mentions = rows.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"), F.lit("rco").alias("source"), raw.alias("raw"))
    heads, credits, _ = events.concerts(mentions)
    return credits.join(heads.select("concert_id", "key"), "concert_id").select("key", "role", "name")


@query("""WITH f AS (SELECT o_custkey, o_orderdate, min(o_orderkey) AS k FROM orders GROUP BY 1, 2) SELECT strftime(o_orderdate, '%Y-%m-%d') || '|' || o_custkey AS key, strftime(o_orderdate, '%Y-%m-%d') AS date,
'Hall ' || k AS venue, count(*) OVER () AS concerts FROM f""")
def ing13_concerts(spark: SparkSession, d: str) -> DataFrame:
    """A date and a city make a concert; its own fields are those of its first mention."""
    raw = F.format_string('{"date": "%s", "city": "%s", "venue": "Hall %s"}', F.date_format("o_orderdate", "dd-MM-yyyy"), "o_custkey", "o_orderkey")
    mentions = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("concertgebouw_archive").alias("source"), raw.alias("raw"))
    heads = events.concerts(mentions)[0]
    total = heads.agg(F.count("*").alias("concerts"))
    return heads.select("key", "date", "venue").crossJoin(F.broadcast(total))


@query("""WITH b AS (SELECT p_brand, min(p_name) AS label, string_agg(DISTINCT 'Q' || p_size, ',' ORDER BY 'Q' || p_size) AS genres, CAST(min(1900 + p_size) AS VARCHAR) AS born FROM part GROUP BY 1)
SELECT 'Q' || substr(p_brand, 7) AS qid, label, genres, born FROM b""")
def con04_bindings(spark: SparkSession, d: str) -> DataFrame:
    """Result bodies of a query service, one a part: labels, distinct values, and dates cut to their precision."""
    body = F.format_string(
        '{"results": {"bindings": [{"item": {"type": "uri", "value": "http://x/Q%s"}, "name": {"type": "literal", "value": "%s"}, "genre": {"type": "uri", "value": "http://x/Q%s"}, "born": {"type": "literal", "value": "%s-01-01T00:00:00Z"}, "bornPrecision": {"type": "literal", "value": "9"}}]}}',
        F.substring("p_brand", 7, 9), "p_name", "p_size", F.col("p_size") + 1900,
    )
    rows = connectors.bindings(table(spark, d, "part").select(body.alias("body")))
    out = connectors.fold_items(rows, "item", ["genre"], ["born"], "name")
    return out.select("qid", "label", F.array_join("genre", ",").alias("genres"), "born")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 < 3 THEN CAST(s_nationkey AS VARCHAR) || '.5,' || CAST(-s_suppkey AS VARCHAR) END AS at FROM supplier""")
def con06_coordinates(spark: SparkSession, d: str) -> DataFrame:
    point = F.format_string("Point(%s %s.5)", (-F.col("s_suppkey")), "s_nationkey")
    return table(spark, d, "supplier").select("s_suppkey", connectors.lat_lon(F.when(F.col("s_suppkey") % 4 < 3, point).otherwise("somewhere")).alias("at"))


@query("""SELECT p_name AS name, 'http://x/' || p_partkey AS url FROM part""")
def con01_people_list(spark: SparkSession, d: str) -> DataFrame:
    """Pages of numbered entries; what is not numbered is metadata."""
    entry = F.format_string('"%s": {"id": "Category:%s", "type": "1", "permlink": "http://x/%s"}', "p_partkey", "p_name", "p_partkey")
    body = F.concat(F.lit("{"), F.array_join(F.collect_list("e"), ","), F.lit(', "metadata": {"id": "Category:no"}}'))
    pages = table(spark, d, "part").select(F.floor(F.col("p_partkey") / 50).alias("page"), entry.alias("e")).groupBy("page").agg(body.alias("body"))
    return connectors.people_list(pages)


@query("""SELECT p_name AS composer, CAST(1700 + p_size AS VARCHAR) AS birth, (1750 + p_size) || '-02-03' AS death, p_type AS epoch, CASE WHEN p_partkey % 3 = 1 THEN 'Trio, ' || p_partkey WHEN p_partkey % 3 = 2 THEN 'Trio' END AS title,
CASE WHEN p_partkey % 3 > 0 THEN 'Chamber' END AS genre FROM part""")
def con11_nested_dump(spark: SparkSession, d: str) -> DataFrame:
    """A composer without works has one row; a padded year is a year."""
    work = _cases("k", "", F.format_string('{"title": "Trio", "subtitle": "%s", "genre": "Chamber"}', "p_partkey"), '{"title": "Trio", "subtitle": "", "genre": "Chamber"}')
    rows = table(spark, d, "part").withColumn("k", F.col("p_partkey") % 3)
    body = F.format_string('{"composers": [{"complete_name": "%s", "birth": "%s-01-01", "death": "%s-02-03", "epoch": "%s", "works": [%s]}]}', "p_name", F.col("p_size") + 1700, F.col("p_size") + 1750, "p_type", work)
    return connectors.nested_dump(rows.select(body.alias("body")))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE 1700 + p_size END AS birth, CASE WHEN p_partkey % 4 = 0 THEN 1760 + p_size END AS death FROM part""")
def con14_life_years(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").withColumn("k", F.col("p_partkey") % 4)
    b, e = F.col("p_size") + 1700, F.col("p_size") + 1760
    said = _cases("k", F.format_string("(%s-%s)", b, e), F.format_string("%s – ", b), F.format_string("b. %s", b), "unknown")
    years = connectors.life_years(said)
    return rows.select("p_partkey", years["birth"].alias("birth"), years["death"].alias("death"))


def _programmes(spark: SparkSession, d: str) -> DataFrame:
    """A programme an order, a work a line; conductors and soloists are suppliers."""
    work = F.format_string('{"ID": "%s", "composerName": "C%s", "workTitle": "W%s", "conductorName": "S%s", "soloists": [{"soloistName": "P%s", "soloistInstrument": "I%s"}]}', "l_linenumber", F.col("l_partkey") % 25, "l_partkey", "l_suppkey", F.col("l_suppkey") % 7, F.col("l_suppkey") % 3)
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(work), ",").alias("w"))
    rows = rows.join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    body = F.format_string('{"programs": [{"programID": "%s", "season": "%s", "concerts": [{"eventType": "E", "Venue": "V%s", "Date": "%sT20:00:00Z"}], "works": [%s, {"ID": "0*", "interval": "Intermission"}]}]}', "l_orderkey", F.date_format("o_orderdate", "yyyy"), F.col("o_custkey") % 5, F.date_format("o_orderdate", "yyyy-MM-dd"), "w")
    return connectors.programmes(rows.select(body.alias("body")))


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS programID, strftime(o_orderdate, '%Y-%m-%d') AS date, 'V' || o_custkey % 5 AS venue, 'C' || l_partkey % 25 AS composer, 'W' || l_partkey AS title, 'S' || l_suppkey AS conductor
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def con17_programmes(spark: SparkSession, d: str) -> DataFrame:
    """One row a programme, concert and work; an intermission is no work."""
    return _programmes(spark, d).select("programID", "date", "venue", "composer", "title", "conductor")


@query("""WITH r AS (SELECT 'conductor' AS role, 'S' || l_suppkey AS name, l_orderkey, strftime(o_orderdate, '%Y') AS y, NULL AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'soloist', 'P' || l_suppkey % 7, l_orderkey, strftime(o_orderdate, '%Y'), 'I' || l_suppkey % 3 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT role, name, count(DISTINCT l_orderkey) AS programs, min(y) AS first, max(y) AS last, coalesce(string_agg(DISTINCT i, ',' ORDER BY i), '') AS disciplines FROM r GROUP BY 1, 2""")
def con16_registry(spark: SparkSession, d: str) -> DataFrame:
    rows = connectors.registry(_programmes(spark, d))
    return rows.withColumn("disciplines", F.array_join("disciplines", ","))


@query("""SELECT p_partkey, p_name || ',Bo Lee' AS names, CASE WHEN p_partkey % 2 = 0 THEN 'violin, viola' ELSE '-' END AS first FROM part""")
def con18_named_parts(spark: SparkSession, d: str) -> DataFrame:
    """Commas in brackets part nothing."""
    said = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, " (violin, viola)").otherwise(""), F.lit("; Bo Lee"))
    parts = connectors.named_parts(said)
    first = F.coalesce(F.get(parts, F.lit(0))["discipline"], F.lit("-"))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(parts, lambda x: x["name"]), ",").alias("names"), first.alias("first"))


@query("""SELECT p_partkey, p_name || ':A;' || CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END || ':B;' || p_brand || ':C' AS rows FROM part""")
def con19_aligned(spark: SparkSession, d: str) -> DataFrame:
    """A work without a composer goes on with the one before it."""
    middle = F.when(F.col("p_partkey") % 2 == 0, F.lit("")).otherwise(F.col("p_type"))
    found = connectors.aligned(F.array("p_name", middle, F.col("p_brand")), F.array(F.lit("A"), F.lit("B"), F.lit("C")))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["composer"], x["title"])), ";").alias("rows"))


@query("""SELECT 'r' || p_partkey AS record_key, p_name AS composer, CASE WHEN k = 0 THEN 'Suite' ELSE p_type END AS title, CAST(CASE WHEN k = 0 THEN 2 ELSE 1 END AS BIGINT) AS tracks, CASE WHEN k = 0 THEN 'Ann/piano,Bo/horn' ELSE 'Cy/' END AS artists
FROM part, (SELECT unnest([0, 1]) AS k)""")
def con22_release_works(spark: SparkSession, d: str) -> DataFrame:
    """Tracks of one work are one row; without a work, what stands before the colon names it."""
    body = F.format_string('{"id": "r%s", "tracks": [{"composer": "%s", "title": "Suite: I", "credits": [{"name": "Ann", "role": "piano"}]}, {"composer": "%s", "title": "Suite: II", "credits": [{"name": "Bo", "role": "horn"}, {"name": "Ann", "role": "piano"}]}, {"work": "%s", "composer": "%s", "title": "x", "credits": [{"name": "Cy"}]}]}', "p_partkey", "p_name", "p_name", "p_type", "p_name")
    rows = connectors.release_works(table(spark, d, "part").select(body.alias("body")))
    people = F.array_join(F.transform("artists", lambda x: F.concat(x["name"], F.lit("/"), F.coalesce(x["role"], F.lit("")))), ",")
    return rows.withColumn("artists", people)


@query("""SELECT p_partkey, p_name || '=piano;Bo Lee=conductor;Cy=' AS credits FROM part""")
def con23_credit_line(spark: SparkSession, d: str) -> DataFrame:
    found = connectors.credit_line(F.concat("p_name", F.lit(", Piano; Bo Lee (Conductor) | Cy")))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(found, lambda x: F.concat(x["name"], F.lit("="), F.coalesce(x["role"], F.lit("")))), ";").alias("credits"))


@query("""SELECT p_partkey, p_name AS composer, CAST(p_size AS VARCHAR) AS duration, p_type AS publisher FROM part""")
def con24_labelled_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Table rows, definition lists and bold labels; the first of equal labels stays."""
    html = F.format_string("<table><tr><th>Composer:</th><td><a href='x'>%s</a></td></tr></table><dl><dt>Duration</dt><dd> %s </dd><dt>Composer</dt><dd>other</dd></dl><p><b>Publisher:</b> %s</p>", "p_name", "p_size", "p_type")
    m = connectors.labelled_pairs(html)
    pick = lambda k, name: F.try_element_at(m, F.lit(k)).alias(name)
    return table(spark, d, "part").select("p_partkey", pick("Composer", "composer"), pick("Duration", "duration"), pick("Publisher", "publisher"))


@query("""SELECT p_partkey, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END AS price FROM part""")
def con25_json_ld(spark: SparkSession, d: str) -> DataFrame:
    """The block of linked data in a page; a broken one says nothing."""
    block = F.format_string('{"@type": "Product", "name": "%s", "offers": {"price": %s}}', "p_name", F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice")).otherwise(F.lit(None)).cast("string"))
    page = F.concat(F.lit('<html><script type="application/ld+json">'), block, F.lit("</script><script>x</script></html>"))
    v = connectors.json_ld(page)
    return table(spark, d, "part").select("p_partkey", F.try_variant_get(v, "$.name", "string").alias("name"), F.try_variant_get(v, "$.offers.price", "double").alias("price"))


@query("""SELECT 'P' || p_partkey AS qid, CASE WHEN p_partkey % 3 = 0 THEN 'M' ELSE 'S' END || p_partkey AS parent FROM part WHERE p_partkey % 3 < 2""")
def con07_genre_counterparts(spark: SparkSession, d: str) -> DataFrame:
    """Of the items that a genre is said to differ from, the one of its name, or of its name and 'music', is its parent."""
    p = table(spark, d, "part")
    node = lambda letter, label: p.select(F.concat(F.lit(letter), "p_partkey").alias("qid"), label.alias("label"))
    k = F.col("p_partkey") % 3
    music = F.when(k == 0, F.concat(F.initcap("p_name"), F.lit(" Music"))).otherwise(F.col("p_type"))
    same = F.when(k == 1, F.concat(F.upper("p_name"), F.lit(" "))).otherwise(F.col("p_brand"))
    nodes = node("P", F.col("p_name")).unionByName(node("M", music)).unionByName(node("S", same))
    pair = lambda letter: p.select(F.concat(F.lit("P"), "p_partkey").alias("qid"), F.concat(F.lit(letter), "p_partkey").alias("other"))
    return connectors.counterparts(nodes, pair("M").unionByName(pair("S")))


@query(f"""WITH {_P} SELECT p_partkey, concat_ws(' · ', CASE WHEN m > 0 THEN 'Conductor, soloist' END, CASE m WHEN 0 THEN '1800–1850' WHEN 1 THEN '1800' WHEN 2 THEN '1850' END,
CASE WHEN m < 4 THEN p_size || ' concerts, 3 recordings' END) AS text FROM p""")
def str35_description(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("m")
    role = F.when(m > 0, "conductor, soloist").otherwise("")
    text = export.description(role, F.when(m < 2, "+1800-05-06"), F.when(m.isin(0, 2), "1850"), F.when(m < 4, F.col("p_size")), F.when(m < 4, F.lit(3)))
    return _part(spark, d).select("p_partkey", text.alias("text"))
