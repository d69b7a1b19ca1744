"""Graph and curation queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import fixpoint, graph, promote
from quillstone.plans.views import composed_by, participants, programmed, table

QUERIES = {}
ORACLE_SQL = {}

#: A genre hierarchy over part types, with one cycle on purpose.
HIERARCHY = (
    ("all", "common"), ("all", "promo"), ("common", "STANDARD"), ("common", "ECONOMY"), ("common", "SMALL"),
    ("promo", "PROMO"), ("promo", "LARGE"), ("promo", "MEDIUM"), ("PROMO", "promo"),
)
_TREE = "h(parent, child) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in HIERARCHY) + ")"


def query(sql: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def _tree(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(HIERARCHY), "parent string, child string")


_CLOSURE = f"""{_TREE}, c AS (SELECT DISTINCT parent AS root, parent AS node FROM h UNION SELECT c.root, h.child FROM c JOIN h ON h.parent = c.node)"""


@query(f"WITH RECURSIVE {_CLOSURE} SELECT root, node FROM c")
def grf04_closure(spark: SparkSession, d: str) -> DataFrame:
    tree = _tree(spark)
    return fixpoint.closure(tree, tree.select(F.col("parent").alias("node")))


@query(f"""WITH RECURSIVE {_CLOSURE}
SELECT root, count(DISTINCT p_partkey) AS works, count(DISTINCT p_brand) AS people FROM c JOIN part ON split_part(p_type, ' ', 1) = node GROUP BY 1""")
def grf05_rollup(spark: SparkSession, d: str) -> DataFrame:
    tagged = table(spark, d, "part").select(F.split_part("p_type", F.lit(" "), F.lit(1)).alias("node"), "p_partkey", "p_brand")
    rows = grf04_closure(spark, d).join(tagged, "node")
    return rows.groupBy("root").agg(F.countDistinct("p_partkey").alias("works"), F.countDistinct("p_brand").alias("people"))


@query(f"""WITH RECURSIVE {_CLOSURE}
SELECT split_part(p_type, ' ', 1) AS genre, count(*) AS n FROM part WHERE split_part(p_type, ' ', 1) NOT IN (
SELECT node FROM c WHERE root = 'promo') GROUP BY 1 ORDER BY n DESC, genre LIMIT 10""")
def grf06_orphans(spark: SparkSession, d: str) -> DataFrame:
    inside = fixpoint.closure(_tree(spark), spark.createDataFrame([("promo",)], "node string")).select(F.col("node").alias("genre"))
    rows = table(spark, d, "part").select(F.split_part("p_type", F.lit(" "), F.lit(1)).alias("genre"))
    rows = rows.join(inside, "genre", "left_anti").groupBy("genre").agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "genre").limit(10)


@query("""SELECT DISTINCT n AS node, n - n % 7 AS root FROM (SELECT unnest([p_partkey, p_partkey + 1]) AS n FROM part WHERE p_partkey % 7 < 5)""")
def lnk11_components(spark: SparkSession, d: str) -> DataFrame:
    """Parts in chains: each is linked to the next, but for every seventh and the one before it."""
    rows = table(spark, d, "part").filter("p_partkey % 7 < 5")
    return fixpoint.components(rows.select(F.col("p_partkey").alias("a"), (F.col("p_partkey") + 1).alias("b")))


@query("""SELECT a.l_suppkey AS a, b.l_suppkey AS b, count(DISTINCT a.l_orderkey) AS shared FROM lineitem a JOIN lineitem b
ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY 1, 2""")
def grf09_appeared_with(spark: SparkSession, d: str) -> DataFrame:
    return graph.shared_pairs(participants(spark, d), "event", "entity")


@query("""WITH c AS (SELECT s_suppkey AS subject, 'based_in' AS predicate, s_nationkey + 1000000 AS object, CAST(s_suppkey % 3 AS VARCHAR) AS source FROM supplier
UNION ALL SELECT c_custkey + 10000000, 'based_in', c_nationkey + 1000000, c_mktsegment FROM customer
UNION ALL SELECT n_nationkey + 1000000, 'located_in', n_regionkey + 2000000, 'n' FROM nation),
w AS (SELECT subject, predicate, object, count(DISTINCT source) AS n FROM c GROUP BY 1, 2, 3),
u AS (SELECT subject AS node, object AS neighbour, predicate, n FROM w UNION ALL SELECT object, subject, predicate, n FROM w)
SELECT node, neighbour, CAST(sum(n) AS BIGINT) AS weight, string_agg(predicate, ',' ORDER BY n DESC, predicate) AS predicates FROM u GROUP BY 1, 2""")
def grf10_claim_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.claim_edges(_claims(spark, d)).withColumn("predicates", F.array_join("predicates", ","))


def _claims(spark: SparkSession, d: str) -> DataFrame:
    """(subject, predicate, object, source) over suppliers, customers, nations and regions, in id ranges of their own."""
    s, c, n = (table(spark, d, x) for x in ("supplier", "customer", "nation"))
    at = lambda k: (F.col(k) + 1000000).cast("long")
    rows = s.select(F.col("s_suppkey").alias("subject"), F.lit("based_in").alias("predicate"), at("s_nationkey").alias("object"), (F.col("s_suppkey") % 3).cast("string").alias("source"))
    rows = rows.union(c.select(F.col("c_custkey") + 10000000, F.lit("based_in"), at("c_nationkey"), "c_mktsegment"))
    return rows.union(n.select(at("n_nationkey"), F.lit("located_in"), (F.col("n_regionkey") + 2000000).cast("long"), F.lit("n")))


@query("""SELECT l_suppkey AS performer, p_brand AS composer, count(DISTINCT l_orderkey) AS events FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def grf15_performer_composer_events(spark: SparkSession, d: str) -> DataFrame:
    plays = programmed(spark, d).join(composed_by(spark, d), "work").select("event", "composer").distinct()
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event"), F.col("l_suppkey").alias("performer"), F.col("l_partkey").alias("work"))
    rows = rows.join(composed_by(spark, d), "work").select("event", "performer", "composer").distinct()
    return rows.join(plays, ["event", "composer"], "left_semi").groupBy("performer", "composer").agg(F.count("*").alias("events"))


_CO = """ec AS (SELECT DISTINCT l_orderkey AS event, p_brand AS c FROM lineitem JOIN part ON l_partkey = p_partkey),
s AS (SELECT c, count(*) AS n FROM ec GROUP BY 1),
p AS (SELECT x.c AS a, y.c AS b, count(*) AS shared FROM ec x JOIN ec y ON x.event = y.event AND x.c < y.c GROUP BY 1, 2)"""


def _events_of_composers(spark: SparkSession, d: str) -> DataFrame:
    return programmed(spark, d).join(composed_by(spark, d), "work").select("event", "composer").distinct()


@query(f"WITH {_CO} SELECT a, b, shared FROM p")
def grf17_co_programming(spark: SparkSession, d: str) -> DataFrame:
    return graph.shared_pairs(_events_of_composers(spark, d), "event", "composer")


@query(f"""WITH {_CO} SELECT a, b, shared, round(shared / sqrt(x.n * y.n), 6) AS cosine FROM p JOIN s x ON x.c = a JOIN s y ON y.c = b
WHERE x.n >= 20 AND shared >= 10""")
def grf18_cosine(spark: SparkSession, d: str) -> DataFrame:
    rows = _events_of_composers(spark, d)
    support = rows.groupBy(F.col("composer").alias("node")).agg(F.count("*").alias("n"))
    return graph.normalised_pairs(graph.shared_pairs(rows, "event", "composer"), support, 20, 10)


@query("""WITH e AS (SELECT s_suppkey AS a, s_nationkey + 1000000 AS b FROM supplier UNION SELECT n_nationkey + 1000000, n_regionkey + 2000000 FROM nation),
u AS (SELECT a, b, a AS x, b AS y FROM e UNION ALL SELECT b, a, a, b FROM e),
h1 AS (SELECT a AS start, b AS node, x AS x1, y AS y1 FROM u WHERE a < 1000000),
h2 AS (SELECT start, b AS node, x1, y1, x AS x2, y AS y2 FROM h1 JOIN u ON a = node WHERE (x, y) <> (x1, y1)),
h3 AS (SELECT start, b AS node FROM h2 JOIN u ON a = node WHERE (x, y) <> (x1, y1) AND (x, y) <> (x2, y2))
SELECT start, node, min(hops) AS hops FROM (SELECT start, node, 1 AS hops FROM h1 UNION ALL SELECT start, node, 2 FROM h2
UNION ALL SELECT start, node, 3 FROM h3) WHERE start <> node GROUP BY 1, 2""")
def grf20_hops(spark: SparkSession, d: str) -> DataFrame:
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    at = lambda c, k: (F.col(c) + k).cast("long")
    edges = s.select(F.col("s_suppkey").alias("a"), at("s_nationkey", 1000000).alias("b"))
    edges = edges.union(n.select(at("n_nationkey", 1000000), at("n_regionkey", 2000000)))
    return graph.hops(edges, s.select(F.col("s_suppkey").alias("node")))


@query("""WITH e AS (SELECT s_suppkey AS a, s_nationkey AS b FROM supplier UNION ALL SELECT s_nationkey, s_suppkey FROM supplier)
SELECT a AS teacher, count(DISTINCT b) AS pupils FROM e GROUP BY 1 ORDER BY pupils DESC, teacher LIMIT 20""")
def grf21_most_linked(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "supplier").select(F.col("s_suppkey").alias("a"), F.col("s_nationkey").cast("long").alias("b"))
    both = e.union(e.select("b", "a")).groupBy(F.col("a").alias("teacher")).agg(F.countDistinct("b").alias("pupils"))
    return both.orderBy(F.desc("pupils"), "teacher").limit(20)


@query("""SELECT n_name AS place, count(*) AS n, array_to_string(list_slice(list(s_name ORDER BY s_name), 1, 8), ',') AS sample
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def grf23_sample_by_place(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    sample = F.array_join(F.slice(F.array_sort(F.collect_list("s_name")), 1, 8), ",")
    return rows.groupBy(F.col("n_name").alias("place")).agg(F.count("*").alias("n"), sample.alias("sample"))


@query("""SELECT n_name AS place, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY 1""")
def grf25_optional_count(spark: SparkSession, d: str) -> DataFrame:
    rich = table(spark, d, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    return table(spark, d, "nation").join(rich, "n_nationkey", "left").groupBy(F.col("n_name").alias("place")).agg(F.count("s_suppkey").alias("n"))


@query(f"""WITH {_TREE} SELECT DISTINCT p_type FROM part WHERE split_part(p_type, ' ', 1) NOT IN (SELECT child FROM h WHERE parent = 'common')""")
def grf26_without_parent(spark: SparkSession, d: str) -> DataFrame:
    child = _tree(spark).filter("parent = 'common'").select(F.col("child").alias("g"))
    rows = table(spark, d, "part").select("p_type", F.split_part("p_type", F.lit(" "), F.lit(1)).alias("g"))
    return rows.join(child, "g", "left_anti").select("p_type").distinct()


@query("""WITH e AS (SELECT l_suppkey AS node, p_brand AS neighbour, count(*) AS weight FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), t AS (SELECT node, sum(weight) AS total FROM e GROUP BY 1 HAVING count(*) >= 10),
l AS (SELECT x.node AS a, y.node AS b, sum(least(x.weight, y.weight)) AS low FROM e x JOIN e y USING (neighbour) WHERE x.node <> y.node GROUP BY 1, 2),
r AS (SELECT a, b, round(low / (x.total + y.total - low), 6) AS similarity FROM l JOIN t x ON x.node = a JOIN t y ON y.node = b)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS INT) AS place FROM r) WHERE place <= 3""")
def grf27_weighted_jaccard(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    edges = rows.groupBy(F.col("l_suppkey").alias("node"), F.col("p_brand").alias("neighbour")).agg(F.count("*").alias("weight"))
    return graph.weighted_jaccard(edges, 3, 10)


@query("""WITH top AS (SELECT l_suppkey AS s FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, s LIMIT 10),
e AS (SELECT l_suppkey AS performer, p_brand AS composer, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_suppkey IN (SELECT s FROM top) GROUP BY 1, 2) SELECT performer, composer, n FROM e WHERE n >= 25""")
def grf29_slice(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    top = lines.groupBy("l_suppkey").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "l_suppkey").limit(10).select("l_suppkey")
    rows = lines.join(top, "l_suppkey", "left_semi").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.groupBy(F.col("l_suppkey").alias("performer"), F.col("p_brand").alias("composer")).agg(F.count("*").alias("n"))
    return rows.filter("n >= 25")


@query("""WITH c AS (SELECT l_suppkey AS root, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'A') AS concerts,
count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R') AS recordings, count(*) AS credits, count(DISTINCT l_partkey) AS works FROM lineitem
WHERE l_quantity >= 48 GROUP BY 1)
SELECT s_suppkey AS root FROM supplier LEFT JOIN c ON root = s_suppkey
WHERE coalesce(concerts, 0) >= 8 OR coalesce(recordings, 0) >= 8 OR (coalesce(credits, 0) >= 20 AND coalesce(works, 0) >= 20) OR s_suppkey >= 90""")
def gld01_evidence(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").filter("l_quantity >= 48").groupBy(F.col("l_suppkey").alias("root"))
    event = lambda flag: F.countDistinct(F.when(F.col("l_returnflag") == flag, F.col("l_orderkey")))
    counts = rows.agg(event("A").alias("concerts"), event("R").alias("recordings"), F.count("*").alias("credits"), F.countDistinct("l_partkey").alias("works"))
    roots = table(spark, d, "supplier").select(F.col("s_suppkey").alias("root"))
    counts = roots.join(counts, "root", "left").withColumns({"programmes": F.lit(0), "sitelinks": F.col("root")})
    rules = promote.EvidenceRules(8, 8, 20, 20, 1, 90)
    return promote.evidenced(roots, counts, rules)


@query("""WITH c AS (SELECT doc_id AS id, (doc_id % 50) // 2 AS subject, 'language' AS predicate, lang AS value, source FROM documents)
SELECT min(id) AS id, subject, predicate, value, source FROM c GROUP BY ALL""")
def gld03_collapse(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    nothing = F.lit(None).cast("long")
    claims = docs.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 50).alias("subject"), F.lit("language").alias("predicate"), nothing.alias("object"), F.col("lang").alias("value"), "source")
    entities = spark.range(50).select("id", F.floor(F.col("id") / 2).alias("canonical"))
    entities = entities.withColumn("canonical", F.col("canonical"))
    return promote.collapse_claims(claims, entities).drop("object")


@query("""WITH RECURSIVE s AS (SELECT s_nationkey AS n FROM supplier WHERE s_acctbal > 3000 GROUP BY 1 HAVING count(*) >= 2),
e(parent, child) AS (SELECT n_nationkey, n_regionkey + 100 FROM nation UNION ALL SELECT r_regionkey + 100, 200 FROM region UNION ALL SELECT 200, 100),
w AS (SELECT n AS node FROM s UNION SELECT child FROM w JOIN e ON parent = node)
SELECT node FROM w UNION SELECT s_suppkey + 1000 FROM supplier WHERE s_acctbal > 3000""")
def gld05_walk(spark: SparkSession, d: str) -> DataFrame:
    s, n, r = (table(spark, d, x) for x in ("supplier", "nation", "region"))
    to_long = lambda c: c.cast("long")
    claims = s.select((F.col("s_suppkey") + 1000).alias("subject"), to_long(F.col("s_nationkey")).alias("object"))
    claims = claims.union(n.select(to_long(F.col("n_nationkey")), to_long(F.col("n_regionkey") + 100)))
    claims = claims.union(r.select(to_long(F.col("r_regionkey") + 100), to_long(F.lit(200)))).union(spark.createDataFrame([(200, 100)], "a long, b long"))
    kinds = s.select((F.col("s_suppkey") + 1000).alias("id"), F.lit("person").alias("kind"))
    kinds = kinds.union(n.select(to_long(F.col("n_nationkey")), F.lit("place")))
    kept = s.filter("s_acctbal > 3000").select((F.col("s_suppkey") + 1000).alias("root"))
    return promote.kept_entities(kept, claims, kinds, promote.EvidenceRules())
