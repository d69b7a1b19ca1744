"""Read queries of the serving layer: lists, details and reports over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import names
from quillstone.operators import linkage, works
from quillstone.operators.relational import capped, paged
from quillstone.plans.views import composed_by, programmed, table

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


@query("""SELECT n_nationkey AS id, n_name AS label, (n_name = 'NATION_1') AS exact FROM nation WHERE n_name ILIKE '%n_1%'
ORDER BY exact DESC, label LIMIT 20""")
def api02_entities(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation").filter(F.col("n_name").ilike("%n_1%"))
    rows = rows.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("label"), (F.col("n_name") == "NATION_1").alias("exact"))
    return paged(rows, [F.desc("exact"), F.col("label")])


@query("""WITH c AS (SELECT s_nationkey AS object, s_suppkey AS subject FROM supplier UNION ALL SELECT c_nationkey, c_custkey FROM customer),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY object ORDER BY subject, n) AS INT) AS place, count(*) OVER (PARTITION BY object) AS incoming
FROM (SELECT *, row_number() OVER (PARTITION BY object, subject) AS n FROM c))
SELECT n_name AS entity, incoming, subject, place FROM r JOIN nation ON n_nationkey = object WHERE place <= 50""")
def api03_entity_details(spark: SparkSession, d: str) -> DataFrame:
    """Incoming claims: how many, and the first fifty."""
    claims = table(spark, d, "supplier").select(F.col("s_nationkey").alias("object"), F.col("s_suppkey").alias("subject"))
    claims = claims.unionByName(table(spark, d, "customer").select(F.col("c_nationkey").alias("object"), F.col("c_custkey").alias("subject")))
    total = claims.groupBy("object").agg(F.count("*").alias("incoming"))
    rows = capped(claims, ["object"], [F.col("subject")], 50).join(total, "object")
    rows = rows.join(table(spark, d, "nation"), F.col("object") == F.col("n_nationkey"))
    return rows.select(F.col("n_name").alias("entity"), "incoming", "subject", "place")


@query("""SELECT s_suppkey AS id, s_name AS label, coalesce(c, 0) AS concerts, coalesce(r, 0) AS recordings FROM supplier LEFT JOIN (
SELECT l_suppkey, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'A') AS c, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R') AS r
FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey WHERE s_acctbal > 0 ORDER BY concerts + recordings DESC, label, id LIMIT 20""")
def api05_ensembles(spark: SparkSession, d: str) -> DataFrame:
    event = lambda f: F.countDistinct(F.when(F.col("l_returnflag") == f, F.col("l_orderkey")))
    counts = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(event("A").alias("c"), event("R").alias("r"))
    rows = table(spark, d, "supplier").filter("s_acctbal > 0").join(counts, "s_suppkey", "left")
    rows = rows.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"), F.coalesce("c", F.lit(0)).alias("concerts"), F.coalesce("r", F.lit(0)).alias("recordings"))
    return paged(rows, [(F.col("concerts") + F.col("recordings")).desc(), F.col("label"), F.col("id")])


@query("""WITH a AS (SELECT l_partkey, count(DISTINCT l_orderkey) AS performances FROM lineitem GROUP BY 1)
SELECT p_partkey AS id, p_name AS title, p_brand AS composer, coalesce(performances, 0) AS performances FROM part LEFT JOIN a ON l_partkey = p_partkey
WHERE p_name ILIKE '%a%' OR p_brand ILIKE '%#1%' ORDER BY performances DESC NULLS LAST, title, id LIMIT 20""")
def api10_works(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.countDistinct("l_orderkey").alias("performances"))
    rows = table(spark, d, "part").filter(F.col("p_name").ilike("%a%") | F.col("p_brand").ilike("%#1%"))
    rows = rows.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("composer")).join(counts, "id", "left")
    rows = rows.withColumn("performances", F.coalesce("performances", F.lit(0)))
    return paged(rows, [F.desc("performances"), F.col("title"), F.col("id")])


@query("""SELECT p_partkey AS id, o_orderkey AS proof, CAST(place AS INT) AS place FROM (SELECT l_partkey AS p_partkey, l_orderkey AS o_orderkey,
row_number() OVER (PARTITION BY l_partkey ORDER BY d DESC, l_orderkey) AS place FROM (SELECT DISTINCT l_partkey, l_orderkey, o_orderdate AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey)) WHERE place <= 5""")
def api11_work_proofs(spark: SparkSession, d: str) -> DataFrame:
    """Distinct first, then capped: repeats do not use up the cap."""
    rows = programmed(spark, d).join(table(spark, d, "orders").select(F.col("o_orderkey").alias("event"), "o_orderdate"), "event")
    rows = capped(rows, ["work"], [F.desc("o_orderdate"), F.col("event")], 5)
    return rows.select(F.col("work").alias("id"), F.col("event").alias("proof"), "place")


@query("""WITH w AS (SELECT l_orderkey, count(*) AS works, count(DISTINCT l_suppkey) AS credits FROM lineitem GROUP BY 1)
SELECT o_orderkey AS id, o_orderdate AS date, c_name AS conductor, coalesce(works, 0) AS works, coalesce(credits, 0) AS soloist_count FROM orders
JOIN customer ON c_custkey = o_custkey LEFT JOIN w ON l_orderkey = o_orderkey WHERE c_name ILIKE '%11%' OR o_orderpriority ILIKE '%urgent%'
ORDER BY date DESC, id LIMIT 20""")
def api13_concerts(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("works"), F.countDistinct("l_suppkey").alias("soloist_count"))
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.filter(F.col("c_name").ilike("%11%") | F.col("o_orderpriority").ilike("%urgent%"))
    rows = rows.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("date"), F.col("c_name").alias("conductor")).join(counts, "id", "left")
    return paged(rows.fillna(0, ["works", "soloist_count"]), [F.desc("date"), F.col("id")])


@query("""SELECT person, id, work, CAST(place AS INT) AS place FROM (SELECT o_custkey AS person, o_orderkey AS id, l_partkey AS work, row_number() OVER (
PARTITION BY o_custkey, o_orderkey ORDER BY l_partkey) AS place FROM orders JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) ON l_orderkey = o_orderkey) WHERE place <= 20""")
def api15_person_concerts(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("event"))
    rows = programmed(spark, d).join(orders, "event")
    return capped(rows, ["person", "event"], [F.col("work")], 20).select("person", F.col("event").alias("id"), "work", "place")


@query("""SELECT p_brand AS composer, count(DISTINCT l_orderkey) AS programmes, count(DISTINCT l_partkey) AS works FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 3 ORDER BY programmes DESC, composer LIMIT 20""")
def api19_composers(spark: SparkSession, d: str) -> DataFrame:
    rows = programmed(spark, d).join(composed_by(spark, d), "work").groupBy("composer")
    rows = rows.agg(F.countDistinct("event").alias("programmes"), F.countDistinct("work").alias("works")).filter("programmes >= 3")
    return paged(rows, [F.desc("programmes"), F.col("composer")])


@query("""SELECT c_custkey AS id, c_name AS label, coalesce(n, 0) AS concerts FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ORDER BY concerts DESC, label LIMIT 20""")
def api21_conductors(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    counts = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("concerts"))
    tagged = orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label")).join(tagged, "id", "left_semi")
    rows = rows.join(counts, "id", "left").withColumn("concerts", F.coalesce("concerts", F.lit(0)))
    return paged(rows, [F.desc("concerts"), F.col("label")])


@query("""SELECT p_brand AS work, p_type AS category, string_agg(DISTINCT p_name, ',' ORDER BY p_name) AS sources FROM part GROUP BY 1, 2""")
def api22_scoring(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").groupBy(F.col("p_brand").alias("work"), F.col("p_type").alias("category"))
    return rows.agg(F.array_join(F.array_sort(F.collect_set("p_name")), ",").alias("sources"))


@query("""SELECT p_brand AS id, count(*) AS n, count(*) FILTER (p_size > 25) AS open FROM part GROUP BY 1""")
def cli06_work_identity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy(F.col("p_brand").alias("id")).agg(F.count("*").alias("n"), F.count_if(F.col("p_size") > 25).alias("open"))


def _people(spark: SparkSession, d: str) -> DataFrame:
    """Distinct part names as people's names: two words, so that each has a surname-first reading."""
    rows = table(spark, d, "part").groupBy("p_name").agg(F.min("p_partkey").alias("id"), F.min("p_size").alias("birth"), F.max("p_size").alias("death"))
    return names.with_readings(rows, "p_name")


@query("""WITH p AS (SELECT p_name, min(p_partkey) AS id, split_part(p_name, ' ', 1) AS g, split_part(p_name, ' ', 2) AS s FROM part GROUP BY 1)
SELECT x.id AS a, y.id AS b FROM p x JOIN p y ON x.id < y.id AND (x.s = y.s OR (x.s = y.g AND x.g = y.s)) """)
def lnk03_candidate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return linkage.candidate_pairs(_people(spark, d))


@query("""WITH n AS (SELECT split_part(p_name, ' ', 2) AS term, count(DISTINCT p_name) AS n FROM part GROUP BY 1) SELECT term, n FROM n""")
def lnk04_term_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return linkage.term_frequencies(_people(spark, d))[0]


#: A trained model's level chances and prior.
MODEL = linkage.LinkageModel(
    prior=0.017617060900290915,
    m={
        "given": {"CONFLICT": 0.18924104604889141, "BOTH_SURNAME_ONLY": 0.001634451392836839, "ONE_SURNAME_ONLY": 0.04341955656623081, "INITIALS": 0.012436043206367254, "PREFIX": 0.10595508811824901, "EXACT": 0.6473138146674247},
        "birth": {"CONFLICT": 0.007731958762886598, "DISTANT": 0.19845360824742267, "CLOSE": 0.06958762886597938, "EXACT": 0.7242268041237113},
        "death": {"CONFLICT": 0.007462686567164179, "DISTANT": 0.1865671641791045, "CLOSE": 0.21641791044776118, "EXACT": 0.5895522388059702},
    },
    u={
        "given": {"CONFLICT": 0.9337860468739182, "BOTH_SURNAME_ONLY": 0.001413963511735789, "ONE_SURNAME_ONLY": 0.04765176036834453, "INITIALS": 0.0014334366128920585, "PREFIX": 0.0034175292529252926, "EXACT": 0.012297263380184172},
        "birth": {"CONFLICT": 0.8097545152041521, "DISTANT": 0.14402263008461866, "CLOSE": 0.03677388750531919, "EXACT": 0.009448967205910052},
        "death": {"CONFLICT": 0.8284968628299437, "DISTANT": 0.12679846386845522, "CLOSE": 0.03533372998701861, "EXACT": 0.009370943314582433},
    },
)


@query()
def lnk06_classified_pairs(spark: SparkSession, d: str) -> DataFrame:
    who = _people(spark, d)
    surnames, givens = linkage.term_frequencies(who), linkage.term_frequencies(who, part="given")
    pairs = linkage.scored(linkage.compared(linkage.candidate_pairs(who), who), MODEL, surnames, givens)
    return linkage.classified(pairs.withColumn("score", F.round("score", 9)))


@query()
def lnk25_resolved_works(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    none = F.array().cast("array<string>")
    rows = part.select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("composer"), F.col("p_partkey").alias("place"),
        works.features(F.concat_ws(" ", "p_name", "p_type"), F.lower("p_brand"), none).alias("f"),
    )
    return works.resolve_in_order(rows)
