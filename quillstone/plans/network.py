"""Vertices, edges, exports and neighbourhood queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import export, fixpoint, graph
from quillstone.operators import relational as R
from quillstone.operators.events import linked_credits
from quillstone.plans.graphs import _TREE, _claims, _tree, grf17_co_programming
from quillstone.plans.views import composed_by, participants, programmed, table

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


@query("""SELECT 'Person' AS label, CAST(s_suppkey AS VARCHAR) AS id, CAST(to_json(struct_pack(label := s_name, sources := ['a', 'b'], url := 'http://b',
born_on := CAST(1900 + s_nationkey AS VARCHAR), sitelink_count := s_suppkey)) AS VARCHAR) AS properties FROM supplier""")
def grf01_vertices(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    people = s.select(F.col("s_suppkey").alias("id"), F.lit("person").alias("kind"), F.col("s_name").alias("label"), F.lit(None).cast("string").alias("qid"))
    others = table(spark, d, "region").select(F.col("r_regionkey").cast("long"), F.lit("event"), "r_name", F.lit(None).cast("string"))
    born = s.select(F.col("s_suppkey").alias("subject"), F.lit("born_on").alias("predicate"), (F.col("s_nationkey") + 1900).cast("string").alias("value"))
    links = s.select("s_suppkey", F.lit("sitelink_count"), F.col("s_suppkey").cast("string"))
    records = s.select(F.col("s_suppkey").alias("id"), F.lit("a").alias("source"), F.lit(None).cast("string").alias("url"))
    records = records.union(s.select("s_suppkey", F.lit("b"), F.lit("http://b")))
    return export.entity_vertices(people.union(others), born.union(links), records)


@query("""SELECT 'PROGRAMMED' AS type, 'Concert' AS start, 'Work' AS "end", CAST(l_orderkey AS VARCHAR) AS "from", CAST(l_partkey AS VARCHAR) AS "to",
'{"times":' || count(*) || '}' AS properties FROM lineitem GROUP BY l_orderkey, l_partkey
UNION ALL SELECT 'BASED_IN', 'Person', 'Place', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey + 1000000 AS VARCHAR), '{"sources":["' || s_suppkey % 3 || '"]}' FROM supplier""")
def grf02_edges(spark: SparkSession, d: str) -> DataFrame:
    """Programmes, and claims whose ends are vertices: customers have no kind here, and regions' claims no type."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event"), F.col("l_partkey").alias("work"))
    people = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("person").alias("kind"))
    places = table(spark, d, "nation").select((F.col("n_nationkey") + 1000000).cast("long"), F.lit("place"))
    found, _ = export.programmed_edges(lines, "Concert")
    return found.unionByName(export.claim_relationships(_claims(spark, d), people.union(places))[0])


@query("""SELECT p_partkey AS id, p_brand AS composer, times_performed, round(p_size / sqrt(greatest(times_performed, 1)), 6) AS affinity FROM part JOIN (
SELECT p_brand, count(*) AS times_performed FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) USING (p_brand)""")
def grf03_reach(spark: SparkSession, d: str) -> DataFrame:
    """Vertices annotated with their reach, and what it makes of a weight [GRF-03, MTH-03]."""
    reach = programmed(spark, d).join(composed_by(spark, d), "work").groupBy("composer").agg(F.sum("times").alias("times_performed"))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("composer"), "p_size").join(reach, "composer")
    affinity = F.round(F.col("p_size") / F.sqrt(F.greatest("times_performed", F.lit(1))), 6)
    return rows.select("id", "composer", "times_performed", affinity.alias("affinity"))


@query("""WITH who AS (SELECT DISTINCT l_orderkey AS e, l_suppkey AS s FROM lineitem), prog AS (SELECT DISTINCT l_orderkey AS e, l_partkey AS w FROM lineitem)
SELECT p_brand AS node, s AS neighbour, count(*) AS weight FROM who JOIN prog USING (e) JOIN part ON w = p_partkey GROUP BY 1, 2""")
def grf08_performed_by(spark: SparkSession, d: str) -> DataFrame:
    """The reverse of performed edges: each (performer, event, work) once, works counted before performers meet them."""
    plays = programmed(spark, d).join(composed_by(spark, d), "work").groupBy("event", "composer").agg(F.count("*").alias("works"))
    rows = participants(spark, d).join(plays, "event").groupBy(F.col("composer").alias("node"), F.col("entity").alias("neighbour"))
    return rows.agg(F.sum("works").alias("weight"))


_FAMILIES = """e AS (SELECT l_suppkey AS node, p_brand AS neighbour, CASE WHEN l_returnflag = 'A' THEN 'performed' ELSE 'performed_by' END AS family,
count(*) AS weight, round(sum(l_linenumber) / sqrt(count(*)), 4) AS score FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""


def _families(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    family = F.when(F.col("l_returnflag") == "A", "performed").otherwise("performed_by")
    rows = rows.groupBy(F.col("l_suppkey").alias("node"), F.col("p_brand").alias("neighbour"), family.alias("family"))
    return rows.agg(F.count("*").alias("weight"), F.round(F.sum("l_linenumber") / F.sqrt(F.count("*")), 4).alias("score"))


@query(f"""WITH {_FAMILIES}, r AS (SELECT *, row_number() OVER (PARTITION BY node, family ORDER BY score DESC, weight DESC, neighbour) AS s,
row_number() OVER (PARTITION BY node, family ORDER BY weight DESC, score DESC, neighbour) AS w FROM e)
SELECT node, family, neighbour, weight, score FROM r WHERE s <= 8 OR w <= 8""")
def grf11_family_pools(spark: SparkSession, d: str) -> DataFrame:
    return R.dual_rank_pool(_families(spark, d), ["node", "family"], 8).select("node", "family", "neighbour", "weight", "score")


@query("""WITH t AS (SELECT DISTINCT l_suppkey AS node, p_brand AS neighbour, p_name || ' (' || year(l_shipdate) || ')' AS proof, year(l_shipdate) AS y
FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT node, neighbour, array_to_string(list_slice(list(proof ORDER BY y DESC, proof DESC), 1, 3), '; ') AS via FROM t GROUP BY 1, 2""")
def grf12_proofs(spark: SparkSession, d: str) -> DataFrame:
    """The newest three works of an edge; repeats go before the cut."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    year = F.year("l_shipdate")
    proof = F.struct(year.alias("y"), F.concat("p_name", F.lit(" ("), year, F.lit(")")).alias("proof"))
    rows = rows.select(F.col("l_suppkey").alias("node"), F.col("p_brand").alias("neighbour"), proof.alias("p")).distinct()
    rows = R.capped(rows, ["node", "neighbour"], [F.desc("p")], 3).groupBy("node", "neighbour")
    return rows.agg(F.array_join(F.transform(F.sort_array(F.collect_list("p"), False), lambda p: p["proof"]), "; ").alias("via"))


_PAGE = f"""WITH {_FAMILIES}, r AS (SELECT *, row_number() OVER (PARTITION BY node, family ORDER BY score DESC, weight DESC, neighbour) AS nth,
count(*) OVER (PARTITION BY node) AS total FROM e WHERE weight >= 2),
b AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY (nth > 6), score DESC, weight DESC, neighbour) AS k FROM r)
SELECT node, neighbour, family AS relation, weight, round(score, 4) AS score,
CAST(row_number() OVER (PARTITION BY node ORDER BY score DESC, weight DESC, neighbour) AS INT) AS place, total FROM b WHERE k <= 24"""


@query(f"""SELECT * EXCLUDE (place) FROM ({_PAGE})""")
def grf14_budgeted_read(spark: SparkSession, d: str) -> DataFrame:
    rows = _families(spark, d).withColumns({"relations": F.array("family"), "affinity": F.col("score"), "raw": F.col("weight").cast("double")})
    return graph.budgeted_read(rows, min_weight=2).drop("place")


@query(f"SELECT neighbour, relation, weight, score, total FROM ({_PAGE}) WHERE node = 7")
def api04_connections(spark: SparkSession, d: str) -> DataFrame:
    """One entity's page: the filter reaches the scan before any ranking."""
    rows = _families(spark, d).filter("node = 7").withColumns({"relations": F.array("family"), "affinity": F.col("score"), "raw": F.col("weight").cast("double")})
    return graph.budgeted_read(rows, min_weight=2).select("neighbour", "relation", "weight", "score", "total")


@query("""SELECT l_suppkey AS performer, p_brand AS composer, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (PARTITION BY l_suppkey), 6) AS share
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def grf16_share_of_repertoire(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "lineitem").join(composed_by(spark, d), F.col("l_partkey") == F.col("work"))
    edges = edges.groupBy(F.col("l_suppkey").alias("performer"), "composer").agg(F.count("*").alias("n"))
    whole = edges.groupBy("performer").agg(F.sum("n").alias("whole"))
    return edges.join(whole, "performer").select("performer", "composer", "n", F.round(100 * F.col("n") / F.col("whole"), 6).alias("share"))


@query("""SELECT a.l_suppkey AS a, b.l_suppkey AS b, count(DISTINCT a.l_orderkey) AS shared FROM lineitem a JOIN lineitem b
ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY 1, 2 ORDER BY shared DESC, a, b LIMIT 25""")
def grf19_shared_stage(spark: SparkSession, d: str) -> DataFrame:
    pairs = graph.shared_pairs(participants(spark, d), "event", "entity")
    return pairs.orderBy(F.desc("shared"), "a", "b").limit(25)


@query("""WITH rel AS (SELECT DISTINCT least(x.p_brand, y.p_brand) AS a, greatest(x.p_brand, y.p_brand) AS b FROM part x JOIN part y
ON y.p_partkey = x.p_partkey + 1 AND x.p_brand <> y.p_brand WHERE x.p_size <= 5), ec AS (SELECT DISTINCT l_orderkey AS e, p_brand AS c FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT a, b, count(*) AS concerts FROM rel JOIN ec x ON x.c = a JOIN ec y ON y.c = b AND y.e = x.e GROUP BY 1, 2""")
def grf22_related_on_programmes(spark: SparkSession, d: str) -> DataFrame:
    """A stated relationship, here of neighbouring parts' brands, backed by shared programmes."""
    x = table(spark, d, "part").filter("p_size <= 5").select((F.col("p_partkey") + 1).alias("k"), F.col("p_brand").alias("x"))
    y = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("y"))
    stated = x.join(y, "k").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return grf17_co_programming(spark, d).join(stated, ["a", "b"]).select("a", "b", F.col("shared").alias("concerts"))


@query("""WITH e AS (SELECT DISTINCT 's' || l_suppkey AS s, p_brand AS c FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 45)
SELECT 's7>Brand#3' AS path, 1 AS hops FROM e WHERE s = 's7' AND c = 'Brand#3'
UNION ALL SELECT 's7>' || x.c || '>' || y.s || '>Brand#3', 3 FROM e x JOIN e y ON y.c = x.c JOIN e z ON z.s = y.s
WHERE x.s = 's7' AND z.c = 'Brand#3' AND x.c <> 'Brand#3' AND y.s <> 's7' AND y.s NOT IN ('s1', 's2', 's3')""")
def grf24_paths(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").filter("l_quantity >= 45").join(composed_by(spark, d), F.col("l_partkey") == F.col("work"))
    edges = lines.select(F.concat(F.lit("s"), "l_suppkey").alias("a"), F.col("composer").alias("b"))
    excluded = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "node string")
    return graph.paths_between(edges, "s7", "Brand#3", excluded)


@query()
def grf28_communities(spark: SparkSession, d: str) -> DataFrame:
    """Two levels of Louvain over entities that shared a stage: no SQL can say it; the tests hold it against known communities."""
    pairs = graph.shared_pairs(participants(spark, d), "event", "entity")
    return graph.communities(pairs.withColumnRenamed("shared", "weight"), levels=2, turns=4)


@query("""WITH w AS (SELECT l_orderkey AS e, l_linestatus AS f, l_suppkey AS s, count(*) AS n FROM lineitem GROUP BY ALL),
c AS (SELECT l_orderkey AS e, l_linestatus AS f, p_brand AS b, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT s AS performer, b AS composer, CAST(sum(w.n * c.n) AS BIGINT) AS weight FROM w JOIN c USING (e, f) GROUP BY 1, 2""")
def agg08_performance_weights(spark: SparkSession, d: str) -> DataFrame:
    """Rows of credits times rows of programme, over both event families."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linestatus", "l_suppkey", F.col("l_partkey").alias("work"))
    who = lines.groupBy("l_orderkey", "l_linestatus", "l_suppkey").agg(F.count("*").alias("n"))
    what = lines.join(composed_by(spark, d), "work").groupBy("l_orderkey", "l_linestatus", "composer").agg(F.count("*").alias("m"))
    rows = who.join(what, ["l_orderkey", "l_linestatus"]).groupBy(F.col("l_suppkey").alias("performer"), "composer")
    return rows.agg(F.sum(F.col("n") * F.col("m")).alias("weight"))


@query("""SELECT l_orderkey AS release, l_suppkey AS participant, arg_min(l_returnflag, struct_pack(a := l_linenumber, b := l_partkey, c := l_returnflag)) AS role
FROM lineitem GROUP BY 1, 2""")
def agg17_first_role(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("release"), F.col("l_suppkey").alias("participant"))
    return rows.agg(F.min_by("l_returnflag", F.struct("l_linenumber", "l_partkey", "l_returnflag")).alias("role"))


@query("""WITH r AS (SELECT user_id, event_id, nullif(event_type, 'click') AS title, CASE WHEN value > 5 THEN CAST(value AS VARCHAR) END AS label,
json_extract_string(props, '$.k') AS format FROM events)
SELECT user_id AS cluster, arg_min(title, struct_pack(a := n, b := event_id)) FILTER (title IS NOT NULL) AS title,
arg_min(label, struct_pack(a := n, b := event_id)) FILTER (label IS NOT NULL) AS label, arg_min(format, struct_pack(a := n, b := event_id)) FILTER (format IS NOT NULL) AS format, count(*) AS mentions
FROM (SELECT *, -((title IS NOT NULL)::INT + (label IS NOT NULL)::INT + (format IS NOT NULL)::INT) AS n FROM r) GROUP BY 1""")
def agg18_fullest_first(spark: SparkSession, d: str) -> DataFrame:
    """Field by field the first value there is, the fullest row first: an aggregate, no sort of a cluster."""
    fields = ("title", "label", "format")
    rows = table(spark, d, "events").select(
        F.col("user_id").alias("cluster"), "event_id", F.nullif("event_type", F.lit("click")).alias("title"),
        F.when(F.col("value") > 5, F.col("value").cast("string")).alias("label"), F.get_json_object("props", "$.k").alias("format"),
    )
    full = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    first = lambda f: F.min_by(f, F.when(F.col(f).isNotNull(), F.struct(-full, F.col("event_id")))).alias(f)
    return rows.groupBy("cluster").agg(*[first(f) for f in fields], F.count("*").alias("mentions"))


@query("""WITH t AS (SELECT DISTINCT p_brand, p_type AS scheme, p_size AS value FROM part)
SELECT p_brand AS work, string_agg(scheme || ' ' || value, ',' ORDER BY scheme, value) AS identifiers, min(value) FILTER (scheme = 'SMALL') AS wikidata FROM t GROUP BY 1""")
def agg29_identifiers(spark: SparkSession, d: str) -> DataFrame:
    pairs = F.array_sort(F.collect_set(F.struct(F.col("p_type").alias("s"), F.col("p_size").alias("v"))))
    rows = table(spark, d, "part").groupBy(F.col("p_brand").alias("work")).agg(pairs.alias("pairs"))
    text = F.array_join(F.transform("pairs", lambda p: F.concat_ws(" ", p["s"], p["v"].cast("string"))), ",")
    one = F.get(F.transform(F.filter("pairs", lambda p: p["s"] == "SMALL"), lambda p: p["v"]), F.lit(0))
    return rows.select("work", text.alias("identifiers"), one.alias("wikidata"))


@query("""SELECT c_nationkey AS id, c_mktsegment AS category, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS sources
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2 ORDER BY category, id""")
def agg30_category_sources(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    rows = rows.groupBy(F.col("c_nationkey").alias("id"), F.col("c_mktsegment").alias("category"))
    return rows.agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("sources")).orderBy("category", "id")


@query("""WITH k AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'ensemble' ELSE 'soloist' END AS role, CAST(l_partkey % 200 AS VARCHAR) AS name FROM lineitem),
e AS (SELECT CAST(s_suppkey AS VARCHAR) AS name, s_suppkey AS entity FROM supplier WHERE s_suppkey < 60),
p AS (SELECT CAST(c_custkey AS VARCHAR) AS name, c_custkey + 1000 AS entity FROM customer WHERE c_custkey BETWEEN 30 AND 120),
a AS (SELECT CAST(p_partkey AS VARCHAR) AS name, p_partkey + 5000 AS entity FROM part WHERE p_partkey BETWEEN 100 AND 150)
SELECT l_orderkey, l_linenumber, role, name, CASE WHEN role = 'ensemble' THEN coalesce(e.entity, p.entity, a.entity) ELSE coalesce(p.entity, e.entity, a.entity) END AS entity
FROM k LEFT JOIN e USING (name) LEFT JOIN p USING (name) LEFT JOIN a USING (name)""")
def jon07_priority_lookup(spark: SparkSession, d: str) -> DataFrame:
    role = F.when(F.col("l_returnflag") == "R", "ensemble").otherwise("soloist")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", role.alias("role"), (F.col("l_partkey") % 200).cast("string").alias("name"))
    named = lambda t, k, plus, where: table(spark, d, t).filter(where).select(F.col(k).cast("string").alias("name"), (F.col(k) + plus).alias("entity"))
    return linked_credits(
        rows, named("supplier", "s_suppkey", 0, "s_suppkey < 60"), named("customer", "c_custkey", 1000, "c_custkey BETWEEN 30 AND 120"),
        named("part", "p_partkey", 5000, "p_partkey BETWEEN 100 AND 150"),
    )


@query("""WITH m AS (SELECT o_orderkey, 'src' || o_orderkey % 3 AS source, o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN ':Q' || o_orderkey ELSE '' END AS external_id FROM orders)
SELECT o_orderkey AS mention, c_custkey AS entity FROM m JOIN customer ON regexp_replace(external_id, ':Q[0-9]+$', '') = CAST(c_custkey AS VARCHAR) AND source = 'src' || c_nationkey % 3""")
def jon11_normalised_key(spark: SparkSession, d: str) -> DataFrame:
    pinned = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(":Q"), "o_orderkey")).otherwise("")
    m = table(spark, d, "orders").select(F.col("o_orderkey").alias("mention"), F.concat(F.lit("src"), F.col("o_orderkey") % 3).alias("source"), F.concat("o_custkey", pinned).alias("external_id"))
    m = m.select("mention", "source", F.regexp_replace("external_id", r":Q\d+$", "").alias("external_id"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("entity"), F.concat(F.lit("src"), F.col("c_nationkey") % 3).alias("source"), F.col("c_custkey").cast("string").alias("external_id"))
    return m.join(c, ["source", "external_id"]).select("mention", "entity")


@query("""SELECT c_custkey AS id, c_name AS label FROM customer ORDER BY md5('173:' || c_custkey), c_custkey LIMIT 20""")
def srt04_random_page(spark: SparkSession, d: str) -> DataFrame:
    """A sampling operator: a page in the order of seeded hashes, so that reruns agree."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label"))
    return rows.orderBy(F.md5(F.concat(F.lit("173:"), F.col("id").cast("string")).cast("binary")), "id").limit(20)


@query("""SELECT p_brand AS composer, string_agg(p_partkey, '>' ORDER BY p_size DESC, p_partkey) AS fold FROM part GROUP BY 1""")
def srt06_ordered_fold(spark: SparkSession, d: str) -> DataFrame:
    held = F.array_sort(F.collect_list(F.struct((-F.col("p_size")).alias("s"), "p_partkey")))
    rows = table(spark, d, "part").groupBy(F.col("p_brand").alias("composer"))
    return rows.agg(F.array_join(F.transform(held, lambda x: x["p_partkey"].cast("string")), ">").alias("fold"))


@query("""SELECT n_name AS label, n_nationkey AS id, count(DISTINCT c_custkey) AS persons FROM nation JOIN customer ON c_nationkey = n_nationkey
WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000) GROUP BY 1, 2 ORDER BY persons DESC, label, id LIMIT 10""")
def srt07_top_orphans(spark: SparkSession, d: str) -> DataFrame:
    inside = table(spark, d, "supplier").filter("s_acctbal > 8000").select(F.col("s_nationkey").alias("n_nationkey"))
    rows = table(spark, d, "nation").join(inside, "n_nationkey", "left_anti").join(table(spark, d, "customer"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.groupBy(F.col("n_name").alias("label"), F.col("n_nationkey").alias("id")).agg(F.countDistinct("c_custkey").alias("persons"))
    return rows.orderBy(F.desc("persons"), "label", "id").limit(10)


@query(f"""WITH RECURSIVE {_TREE}, c AS (SELECT 'promo' AS node UNION SELECT child FROM c JOIN h ON parent = node)
SELECT node, count(p_partkey) AS works FROM c LEFT JOIN part ON split_part(p_type, ' ', 1) = node GROUP BY 1""")
def set02_recursive_union(spark: SparkSession, d: str) -> DataFrame:
    """A recursive union of distinct rows from one seed: its cycle ends."""
    inside = fixpoint.closure(_tree(spark), spark.createDataFrame([("promo",)], "node string")).select("node")
    works = table(spark, d, "part").select(F.split_part("p_type", F.lit(" "), F.lit(1)).alias("node"), "p_partkey")
    return inside.join(works, "node", "left").groupBy("node").agg(F.count("p_partkey").alias("works"))


@query("""WITH f AS (SELECT c_nationkey AS id, c_mktsegment AS v, min(c_custkey) AS first FROM customer GROUP BY 1, 2)
SELECT id, string_agg(v, ',' ORDER BY first) AS kept FROM f GROUP BY 1""")
def arr01_ordered_distinct(spark: SparkSession, d: str) -> DataFrame:
    held = F.array_sort(F.collect_list(F.struct("c_custkey", "c_mktsegment")))
    rows = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("id"))
    return rows.agg(F.array_join(F.array_distinct(F.transform(held, lambda x: x["c_mktsegment"])), ",").alias("kept"))


@query("""SELECT s_suppkey AS id, CASE WHEN s_nationkey % 2 = 0 THEN '{"label":"' || s_name || '"}' ELSE '{"label":"' || s_name || '","region":' || s_nationkey || '}' END AS properties FROM supplier""")
def prj05_properties(spark: SparkSession, d: str) -> DataFrame:
    region = F.when(F.col("s_nationkey") % 2 == 1, F.col("s_nationkey"))
    empty = F.array().cast("array<string>")
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), export.properties({"label": F.col("s_name"), "region": region, "sources": empty}).alias("properties"))


@query("""SELECT s_suppkey AS id, s_name AS label, 'supplier:' || s_suppkey AS key, s_acctbal > 0 AS solvent FROM supplier""")
def prj01_relabelled(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").withColumnsRenamed({"s_suppkey": "id", "s_name": "label"})
    return rows.select("id", "label", F.concat(F.lit("supplier:"), "id").alias("key"), (F.col("s_acctbal") > 0).alias("solvent"))


@query("""SELECT 'vertices' AS "table", 'supplier' AS label, count(*) AS n FROM supplier UNION ALL SELECT 'vertices', 'nation', count(*) FROM nation
UNION ALL SELECT 'edges', 'programmed', count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)""")
def cli09_export_counts(spark: SparkSession, d: str) -> DataFrame:
    """What an export would hold, by label and type."""
    row = lambda df, t, name: df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), F.lit(name).alias("label"), "n")
    out = row(table(spark, d, "supplier"), "vertices", "supplier").unionByName(row(table(spark, d, "nation"), "vertices", "nation"))
    return out.unionByName(row(programmed(spark, d), "edges", "programmed"))


@query()
def src16_blueprint(spark: SparkSession, d: str) -> DataFrame:
    """A map's elements and connections as JSON: the ten most credited performers and what they lead to."""
    s, part = table(spark, d, "supplier"), composed_by(spark, d)
    lines = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("work"))
    entities = s.select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.lit("ensemble").alias("kind"), F.col("s_name").alias("label"))
    entities = entities.union(part.select("composer", F.lit("person"), F.col("composer").alias("label")).distinct())
    credits = lines.select(F.concat(F.lit("s"), "l_suppkey").alias("entity"), F.lit("ensemble").alias("role"), (F.col("l_linestatus") == "F").alias("recording"))
    edges = lines.groupBy(F.concat(F.lit("s"), "l_suppkey").alias("performer"), "composer").agg(F.count("*").alias("weight"))
    claims = spark.createDataFrame([], "subject string, predicate string, object string, value string, source string")
    records = spark.createDataFrame([], "id string, source string, url string")
    elements, links = export.blueprint(entities, credits, edges, claims, records, export.Slice(performers=10, min_weight=20))
    return elements.select(F.lit("element").alias("part"), "json").unionByName(links.select(F.lit("connection").alias("part"), "json"))
