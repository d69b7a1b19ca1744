"""Filters, joins, aggregates, windows, orders and sets over the driver's tables: one query an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators import linkage
from quillstone.operators import relational as R
from quillstone.plans.views import composed_by, participants, programmed, table

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str):
    """Registers the function under its name, with its SQL twin."""

    def keep(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return keep


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal IS NOT NULL")
def flt01_equality(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").filter((F.col("c_mktsegment") == "BUILDING") & F.col("c_acctbal").isNotNull())
    return rows.select("c_custkey", "c_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RE%'")
def flt02_substring_search(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").filter(F.col("p_name").ilike("%RE%")).select("p_partkey", "p_name")


@query("""SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE s_name ILIKE '%7%' OR n_name ILIKE '%an%'""")
def flt03_search_own_or_joined(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.filter(F.col("s_name").ilike("%7%") | F.col("n_name").ilike("%an%")).select("s_suppkey", "s_name", "n_name")


@query("""SELECT p_partkey, (p_type LIKE 'PROMO%' OR p_size > 40) AS anchored FROM part
WHERE NOT (p_type LIKE 'PROMO%' OR p_size > 40)""")
def flt04_unanchored(spark: SparkSession, d: str) -> DataFrame:
    anchored = F.col("p_type").startswith("PROMO") | (F.col("p_size") > 40)
    return table(spark, d, "part").filter(~anchored).select("p_partkey", anchored.alias("anchored"))


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def flt05_constant_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query("""SELECT c_custkey FROM customer WHERE c_custkey IN (
SELECT o_custkey FROM orders WHERE o_totalprice > 200000)""")
def flt06_semi_join(spark: SparkSession, d: str) -> DataFrame:
    rich = table(spark, d, "orders").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(rich, "c_custkey", "left_semi")


@query("""SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def flt07_not_exists(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey").join(lines, "o_orderkey", "left_anti")


@query("SELECT EXISTS (SELECT 1 FROM events) AS stored")
def flt08_not_empty(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").limit(1).agg((F.count("*") > 0).alias("stored"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY 1")
def flt09_status_set(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").filter(F.col("o_orderstatus").isin("O", "P"))
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT event_id, TRY_CAST(regexp_extract(props, ':\\s*(.*)\\}', 1) AS INT) AS k FROM events
WHERE regexp_matches(regexp_extract(props, ':\\s*(.*)\\}', 1), '^[0-9]+$')""")
def flt10_numeric_guard(spark: SparkSession, d: str) -> DataFrame:
    value = F.regexp_extract("props", r":\s*(.*)\}", 1)
    rows = table(spark, d, "events").filter(value.rlike("^[0-9]+$"))
    return rows.select("event_id", value.try_cast("int").alias("k"))


@query("""WITH v(predicate, kind) AS (VALUES ('based_in', 'AUTOMOBILE'), ('based_in', 'BUILDING'))
SELECT c_custkey AS subject, 'based_in' AS predicate, c_mktsegment AS kind FROM customer
WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.predicate = 'based_in' AND v.kind = c_mktsegment)""")
def flt11_vocabulary_check(spark: SparkSession, d: str) -> DataFrame:
    allowed = spark.createDataFrame([("based_in", "AUTOMOBILE"), ("based_in", "BUILDING")], "predicate string, kind string")
    claims = table(spark, d, "customer").select(F.col("c_custkey").alias("subject"), F.lit("based_in").alias("predicate"), F.col("c_mktsegment").alias("kind"))
    return R.quarantine(claims, allowed).select("subject", "predicate", "kind")


@query("""WITH typed AS (SELECT p_partkey FROM part WHERE p_size <= 5)
SELECT p_partkey, p_partkey % 100 AS canonical FROM part
WHERE p_partkey IN (SELECT * FROM typed) OR p_partkey % 100 IN (SELECT * FROM typed)""")
def flt12_own_or_canonical(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    typed = part.filter("p_size <= 5").select(F.col("p_partkey").alias("t"))
    rows = part.select("p_partkey", (F.col("p_partkey") % 100).alias("canonical"))
    own = rows.join(typed, rows["p_partkey"] == typed["t"], "left_semi")
    return own.union(rows.join(typed, rows["canonical"] == typed["t"], "left_semi")).distinct()


@query("""SELECT p_partkey, nullif(trim(concat_ws(' ', CASE WHEN p_size > 10 THEN p_brand END,
CASE WHEN p_size < 30 THEN CAST(p_size AS VARCHAR) END)), '') AS catalogue FROM part""")
def prj02_catalogue_text(spark: SparkSession, d: str) -> DataFrame:
    prefix = F.when(F.col("p_size") > 10, F.col("p_brand"))
    number = F.when(F.col("p_size") < 30, F.col("p_size").cast("string"))
    text = F.trim(F.concat_ws(" ", prefix, number))
    return table(spark, d, "part").select("p_partkey", F.nullif(text, F.lit("")).alias("catalogue"))


@query("""SELECT page_id, CASE WHEN url IS NULL OR rtrim(url, '/') = rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*', 0), '/')
THEN NULL ELSE url END AS deep FROM pages""")
def prj03_deep_link(spark: SparkSession, d: str) -> DataFrame:
    bare = lambda x: F.rtrim(x, F.lit("/"))
    base = F.regexp_extract("url", "^[a-z]+://[^/?#]*", 0)
    return table(spark, d, "pages").select("page_id", F.when(bare(F.col("url")) != bare(base), F.col("url")).alias("deep"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def prj04_json_field(spark: SparkSession, d: str) -> DataFrame:
    value = F.try_variant_get(F.try_parse_json("props"), "$.k", "string")
    return table(spark, d, "events").select("event_id", value.alias("k"))


@query("""SELECT c_custkey, CAST(o.n AS BIGINT) AS orders, n_name, r_name FROM customer
JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def jon01_claims_with_lookups(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return rows.join(counts, "c_custkey", "left").select("c_custkey", "orders", "n_name", "r_name")


@query("""SELECT l_orderkey, l_partkey, a.p_name AS resolved, b.p_name AS candidate, count(*) AS n FROM lineitem
LEFT JOIN part a ON a.p_partkey = l_partkey LEFT JOIN part b ON b.p_partkey = l_partkey + 1 GROUP BY ALL""")
def jon02_joined_twice(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    a = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("resolved"))
    b = part.select((F.col("p_partkey") - 1).alias("l_partkey"), F.col("p_name").alias("candidate"))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n"))
    return rows.join(a, "l_partkey", "left").join(b, "l_partkey", "left")


@query("""SELECT p_partkey, count(l_orderkey) AS listed, count(o_orderkey) AS dated, count(c_custkey) AS known FROM part
LEFT JOIN lineitem ON l_partkey = p_partkey LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'
LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def jon03_proof_chain(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey")
    orders = table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    rows = table(spark, d, "part").select("p_partkey").join(lines, "p_partkey", "left")
    rows = rows.join(orders, rows["l_orderkey"] == orders["o_orderkey"], "left")
    rows = rows.join(table(spark, d, "customer").select("c_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.groupBy("p_partkey").agg(F.count("l_orderkey").alias("listed"), F.count("o_orderkey").alias("dated"), F.count("c_custkey").alias("known"))


@query("""SELECT s_suppkey, coalesce(n, 0) AS appearances FROM supplier LEFT JOIN (
SELECT l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem WHERE l_quantity > 49 GROUP BY 1) ON l_suppkey = s_suppkey""")
def jon04_counts_then_outer_join(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "lineitem").filter("l_quantity > 49").groupBy(F.col("l_suppkey").alias("s_suppkey"))
    counts = counts.agg(F.countDistinct("l_orderkey").alias("n"))
    rows = table(spark, d, "supplier").select("s_suppkey").join(counts, "s_suppkey", "left")
    return rows.select("s_suppkey", F.coalesce("n", F.lit(0)).alias("appearances"))


@query("""SELECT s_nationkey AS performer, p_brand AS composer, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2""")
def jon05_many_to_many(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    lines = lines.join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(table(spark, d, "orders").filter("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy(F.col("s_nationkey").alias("performer"), F.col("p_brand").alias("composer")).agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def jon06_anti_count(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").join(orders, "l_orderkey", "left_anti").agg(F.count("*").alias("orphans"))


@query("""WITH a AS (SELECT p_name AS name, min(p_partkey) AS target, max(p_partkey) AS other, count(*) AS n FROM part WHERE p_size < 25 GROUP BY 1)
SELECT p_partkey, CASE WHEN target = other THEN target END AS target FROM part LEFT JOIN a ON name = p_name""")
def jon08_unique_match(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    targets = part.filter("p_size < 25").select("p_name", F.col("p_partkey").alias("target"))
    return R.unique_match(part, targets, "p_name", "target").select("p_partkey", "target")


@query("""WITH a AS (SELECT p_name, min(p_partkey) AS x, max(p_partkey) AS y FROM part WHERE p_size < 3 GROUP BY 1),
b AS (SELECT p_name, min(p_partkey) AS x, max(p_partkey) AS y FROM part WHERE p_size = 9 GROUP BY 1)
SELECT p_partkey, CASE WHEN a.p_name IS NULL THEN CASE WHEN b.x = b.y THEN b.x END WHEN a.x = a.y THEN a.x END AS target
FROM part LEFT JOIN a USING (p_name) LEFT JOIN b USING (p_name)""")
def jon09_two_tier_match(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    held = lambda rows: rows.select("p_name", F.col("p_partkey").alias("target"))
    out = R.two_tier_match(part, held(part.filter("p_size < 3")), held(part.filter("p_size = 9")), "p_name", "target")
    return out.select("p_partkey", "target")


@query("""SELECT a.s AS a, b.s AS b, count(*) AS shared FROM (SELECT DISTINCT l_suppkey AS s, l_orderkey AS k FROM lineitem) a
JOIN (SELECT DISTINCT l_suppkey AS s, l_orderkey AS k FROM lineitem) b ON a.k = b.k AND a.s < b.s
WHERE a.k IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) <= 6) GROUP BY 1, 2""")
def jon12_shared_key_pairs(spark: SparkSession, d: str) -> DataFrame:
    return R.shared_key_pairs(table(spark, d, "lineitem"), "l_suppkey", ["l_orderkey"], 6)


@query("""WITH r AS (SELECT p_partkey AS id, p_partkey AS lo, p_partkey + p_size AS hi FROM part WHERE p_size > 40),
m AS (SELECT p_partkey AS number, id, hi - lo AS width FROM part JOIN r ON p_partkey BETWEEN lo AND hi AND p_partkey <> id)
SELECT number, arg_min(id, struct_pack(w := width, i := id)) AS parent FROM m GROUP BY 1""")
def jon14_smallest_range(spark: SparkSession, d: str) -> DataFrame:
    """Ranges become members by explosion, so that containment is an equi-join."""
    part = table(spark, d, "part")
    ranges = part.filter("p_size > 40").select(F.col("p_partkey").alias("id"), "p_size")
    members = ranges.select("id", "p_size", F.explode(F.sequence("id", F.col("id") + F.col("p_size"))).alias("number"))
    rows = members.filter("number <> id").join(part.select(F.col("p_partkey").alias("number")), "number")
    return rows.groupBy("number").agg(F.min_by("id", F.struct("p_size", "id")).alias("parent"))


@query("""SELECT 'status' AS facet, o_orderstatus AS name, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM customer GROUP BY 2""")
def agg01_stats(spark: SparkSession, d: str) -> DataFrame:
    def facet(name: str, t: str, c: str) -> DataFrame:
        return table(spark, d, t).groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n")).withColumn("facet", F.lit(name))

    return facet("status", "orders", "o_orderstatus").unionByName(facet("segment", "customer", "c_mktsegment"))


@query("SELECT l_suppkey, count(DISTINCT l_orderkey) AS events FROM lineitem GROUP BY 1")
def agg02_distinct_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("events"))


@query("""SELECT p_brand AS entity, count(DISTINCT l_orderkey) FILTER (o_orderstatus = 'F') AS concert_count,
count(DISTINCT l_orderkey) FILTER (o_orderstatus <> 'F') AS recording_count, count(DISTINCT l_orderkey) AS programme_count
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def agg03_programme_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = programmed(spark, d).join(composed_by(spark, d), "work").select("event", F.col("composer").alias("entity"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("event"), "o_orderstatus")
    rows = rows.join(orders, "event")
    return R.programme_counts(rows.filter("o_orderstatus = 'F'"), rows.filter("o_orderstatus <> 'F'"))


@query("""SELECT l_suppkey // 10 AS root, count(DISTINCT l_orderkey) FILTER (o_orderstatus = 'F') AS concerts,
count(DISTINCT l_orderkey) FILTER (o_orderstatus <> 'F') AS recordings FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def agg04_appearances_by_root(spark: SparkSession, d: str) -> DataFrame:
    rows = participants(spark, d).select("event", F.floor(F.col("entity") / 10).alias("root"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("event"), "o_orderstatus")
    rows = rows.join(orders, "event").distinct()
    live = F.col("o_orderstatus") == "F"
    return rows.groupBy("root").agg(F.count_if(live).alias("concerts"), F.count_if(~live).alias("recordings"))


@query("""SELECT l_suppkey AS entity, count(DISTINCT coalesce(CASE WHEN l_partkey % 3 > 0 THEN CAST(l_partkey AS VARCHAR) END, lower(p_name))) AS works,
count(DISTINCT (l_linestatus, l_orderkey)) AS programmes FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def agg05_reach(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    work = F.coalesce(F.when(F.col("l_partkey") % 3 > 0, F.col("l_partkey").cast("string")), F.lower("p_name"))
    return rows.groupBy(F.col("l_suppkey").alias("entity")).agg(
        F.countDistinct(work).alias("works"), F.countDistinct("l_linestatus", "l_orderkey").alias("programmes")
    )


@query("""SELECT user_id // 10 AS root, max(TRY_CAST(json_extract_string(props, '$.k') AS INT)) AS best FROM events GROUP BY 1""")
def agg06_max_numeric(spark: SparkSession, d: str) -> DataFrame:
    value = F.get_json_object("props", "$.k").try_cast("int")
    return table(spark, d, "events").groupBy(F.floor(F.col("user_id") / 10).alias("root")).agg(F.max(value).alias("best"))


@query("""SELECT l_partkey AS object, count(DISTINCT l_suppkey) AS referrers FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) >= 20""")
def agg07_referrers(spark: SparkSession, d: str) -> DataFrame:
    claims = table(spark, d, "lineitem").select(F.col("l_partkey").alias("object"), F.col("l_suppkey").alias("subject"))
    return R.referred(claims, 20)


@query("""SELECT l_suppkey AS entity, count(*) AS credits, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS roles FROM lineitem GROUP BY 1""")
def agg09_roles(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("entity"))
    return rows.agg(F.count("*").alias("credits"), F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("roles"))


@query("SELECT l_orderkey AS event, l_partkey AS work, count(*) AS times FROM lineitem GROUP BY 1, 2")
def agg10_multiplicity(spark: SparkSession, d: str) -> DataFrame:
    return programmed(spark, d)


@query("""SELECT doc_id % 97 AS subject, lang AS object, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM documents GROUP BY 1, 2""")
def agg11_sources_of_claims(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").groupBy((F.col("doc_id") % 97).alias("subject"), F.col("lang").alias("object"))
    return rows.agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


@query("""WITH c AS (SELECT doc_id % 97 AS subject, source AS v, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT subject, string_agg(v, ',' ORDER BY n DESC, v) AS ordered FROM c GROUP BY 1""")
def agg12_values_by_count(spark: SparkSession, d: str) -> DataFrame:
    claims = table(spark, d, "documents").select((F.col("doc_id") % 97).alias("subject"), "source")
    return R.values_by_count(claims, ["subject"], "source").select("subject", F.array_join("values", ",").alias("ordered"))


@query("""SELECT c_nationkey AS entity, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ',') AS names,
arg_min(c_name, struct_pack(s := c_mktsegment, k := c_custkey)) AS first_name FROM customer GROUP BY 1""")
def agg13_sources_and_first(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("entity"))
    return rows.agg(
        F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("names"),
        F.min_by("c_name", F.struct("c_mktsegment", "c_custkey")).alias("first_name"),
    )


@query("""WITH c AS (SELECT c_nationkey AS subject, CAST(floor(c_acctbal / 1000) AS BIGINT) AS year, count(*) AS n FROM customer GROUP BY 1, 2)
SELECT subject, arg_min(year, struct_pack(a := -n, b := year)) AS year FROM c GROUP BY 1""")
def agg15_consensus(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("subject"), F.floor(F.col("c_acctbal") / 1000).alias("year"))
    return R.consensus(rows, ["subject"], "year")


@query("""SELECT l_orderkey AS event, arg_min(l_shipdate, struct_pack(a := l_linenumber, b := l_partkey, c := l_shipdate)) AS date, count(DISTINCT l_suppkey) AS artists,
array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS names FROM lineitem GROUP BY 1""")
def agg16_fold_event(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("event"))
    first = F.min_by("l_shipdate", F.struct("l_linenumber", "l_partkey", "l_shipdate"))
    names = F.array_sort(F.collect_set("l_suppkey"))
    return rows.agg(first.alias("date"), F.countDistinct("l_suppkey").alias("artists"), F.array_join(names.cast("array<string>"), ",").alias("names"))


@query("""SELECT user_id % 20 AS source, count(*) AS seen, count(*) FILTER (event_type = 'click') AS confirmed,
count(*) FILTER (event_type <> 'click') AS unconfirmed FROM events GROUP BY 1""")
def agg19_unconfirmed(spark: SparkSession, d: str) -> DataFrame:
    done = F.col("event_type") == "click"
    rows = table(spark, d, "events").groupBy((F.col("user_id") % 20).alias("source"))
    return rows.agg(F.count("*").alias("seen"), F.count_if(done).alias("confirmed"), F.count_if(~done).alias("unconfirmed"))


@query("""SELECT source, count(*) AS n, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1
UNION ALL SELECT '(all)', count(*), count(quality) FROM documents LEFT JOIN labels USING (doc_id)""")
def agg20_coverage_with_total(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left")
    total = rows.rollup("source").agg(F.count("*").alias("n"), F.count("quality").alias("labelled"), F.grouping("source").alias("g"))
    return total.select(F.when(F.col("g") == 1, "(all)").otherwise(F.col("source")).alias("source"), "n", "labelled")


@query("""SELECT least(p_size // 10, 3) AS size_level, CASE WHEN p_retailprice < 1000 THEN 0 ELSE 1 END AS price_level, count(*) AS n
FROM part GROUP BY 1, 2""")
def agg21_level_patterns(spark: SparkSession, d: str) -> DataFrame:
    size = F.least(F.floor(F.col("p_size") / 10), F.lit(3)).cast("int")
    price = F.when(F.col("p_retailprice") < 1000, 0).otherwise(1)
    return table(spark, d, "part").groupBy(size.alias("size_level"), price.alias("price_level")).agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey)
SELECT round(exp(sum(n * (n - 1) / 2 * ln(n)) / sum(n * (n - 1) / 2)), 6) AS reference FROM f WHERE n > 1 AND n <= 30""")
def agg22_weighted_geometric_mean(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return linkage.pair_weighted_mean(counts, 30).select(F.round("reference", 6).alias("reference"))


@query("""WITH p AS (SELECT lang, (n_chars < 900) AS guess, quality = 0 AS truth FROM documents JOIN labels USING (doc_id)),
c AS (SELECT coalesce(lang, '(all)') AS stratum, count(*) FILTER (guess AND truth) AS tp, count(*) FILTER (guess AND NOT truth) AS fp,
count(*) FILTER (NOT guess AND truth) AS fn FROM p GROUP BY ROLLUP (lang))
SELECT stratum, tp, fp, fn, round(tp / (tp + fp), 6) AS precision_, round(tp / (tp + fn), 6) AS recall_,
round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def agg23_confusion(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(table(spark, d, "labels"), "doc_id")
    guess, truth = F.col("n_chars") < 900, F.col("quality") == 0
    out = rows.rollup("lang").agg(F.count_if(guess & truth).alias("tp"), F.count_if(guess & ~truth).alias("fp"), F.count_if(~guess & truth).alias("fn"))
    share = lambda a, b: F.round(F.try_divide(a, b), 6)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.select(
        F.coalesce("lang", F.lit("(all)")).alias("stratum"), "tp", "fp", "fn", share(tp, tp + fp).alias("precision_"),
        share(tp, tp + fn).alias("recall_"), share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


@query("""SELECT p_brand AS composer, count(*) AS times_performed, count(DISTINCT l_orderkey) AS performances,
count(DISTINCT l_suppkey) AS appearances FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def agg24_reach_annotations(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(F.col("p_brand").alias("composer")).agg(
        F.count("*").alias("times_performed"), F.countDistinct("l_orderkey").alias("performances"), F.countDistinct("l_suppkey").alias("appearances")
    )


@query("""WITH w AS (SELECT l_suppkey AS entity, weight, count(*) AS n FROM (
SELECT l_suppkey, p_brand, count(*) AS weight FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) GROUP BY 1, 2)
SELECT entity, string_agg(weight || ':' || n, ',' ORDER BY weight) AS weights FROM w GROUP BY 1""")
def agg25_weight_histogram(spark: SparkSession, d: str) -> DataFrame:
    edges = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    edges = edges.groupBy(F.col("l_suppkey").alias("entity"), "p_brand").agg(F.count("*").alias("weight"))
    text = F.transform("weights", lambda x: F.concat_ws(":", x["weight"].cast("string"), x["n"].cast("string")))
    return R.weight_histogram(edges, ["entity"]).select("entity", F.array_join(text, ",").alias("weights"))


@query("""SELECT p_brand AS composer, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 6) AS share
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def agg26_share(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.groupBy(F.col("p_brand").alias("composer")).agg(F.count("*").alias("n"))
    return rows.withColumn("share", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("""SELECT l_returnflag AS role, l_suppkey AS name, count(DISTINCT l_orderkey) AS programs, min(l_shipdate) AS first, max(l_shipdate) AS last
FROM lineitem GROUP BY 1, 2""")
def agg27_person_seasons(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("role"), F.col("l_suppkey").alias("name"))
    return rows.agg(F.countDistinct("l_orderkey").alias("programs"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))


@query("""SELECT p_brand AS entity, string_agg(DISTINCT p_type, ',' ORDER BY p_type) FILTER (p_size > 25) AS large, min(p_type) AS shown FROM part GROUP BY 1""")
def agg28_describing_facts(spark: SparkSession, d: str) -> DataFrame:
    large = F.array_sort(F.collect_set(F.when(F.col("p_size") > 25, F.col("p_type"))))
    rows = table(spark, d, "part").groupBy(F.col("p_brand").alias("entity"))
    return rows.agg(F.nullif(F.array_join(large, ","), F.lit("")).alias("large"), F.min("p_type").alias("shown"))


_EDGES = """e AS (SELECT l_suppkey AS entity, p_brand AS neighbour, count(*) AS weight, round(count(*) / sqrt(p_size_sum), 6) AS score
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN (SELECT p_brand AS b, sum(p_size) AS p_size_sum FROM part GROUP BY 1) ON b = p_brand
GROUP BY 1, 2, p_size_sum)"""


def _edges(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    size = part.groupBy(F.col("p_brand").alias("neighbour")).agg(F.sum("p_size").alias("size"))
    rows = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.groupBy(F.col("l_suppkey").alias("entity"), F.col("p_brand").alias("neighbour")).agg(F.count("*").alias("weight"))
    rows = rows.join(size, "neighbour").withColumn("score", F.round(F.col("weight") / F.sqrt("size"), 6))
    return rows.select("entity", "neighbour", "weight", "score")


@query(f"""WITH {_EDGES}, r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY score DESC, weight DESC, neighbour) AS s,
row_number() OVER (PARTITION BY entity ORDER BY weight DESC, score DESC, neighbour) AS w FROM e)
SELECT entity, neighbour, weight, score FROM r WHERE s <= 5 OR w <= 5""")
def win01_dual_rank_pool(spark: SparkSession, d: str) -> DataFrame:
    return R.dual_rank_pool(_edges(spark, d), ["entity"], 5)


@query("""SELECT l_orderkey, l_partkey, place FROM (SELECT l_orderkey, l_partkey, CAST(row_number() OVER (
PARTITION BY l_orderkey ORDER BY l_partkey) AS INT) AS place FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) WHERE place <= 2""")
def win02_capped(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").distinct()
    return R.capped(rows, ["l_orderkey"], [F.col("l_partkey")], 2)


@query("""SELECT c_mktsegment, c_nationkey, min(c_custkey) AS c_custkey FROM customer GROUP BY 1, 2""")
def win03_first_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_mktsegment", "c_nationkey", "c_custkey")
    return R.first_wins(rows, ["c_mktsegment", "c_nationkey"], "c_custkey")


@query(f"""WITH {_EDGES}, r AS (SELECT *, substr(neighbour, 7, 1) AS relation FROM e),
a AS (SELECT *, row_number() OVER (PARTITION BY entity, relation ORDER BY score DESC, weight DESC, neighbour) > 1 AS spare FROM r),
b AS (SELECT *, CAST(row_number() OVER (PARTITION BY entity ORDER BY spare, score DESC, weight DESC, neighbour) AS INT) AS place FROM a)
SELECT entity, relation, neighbour, weight, score, place FROM b WHERE place <= 8""")
def win04_budgeted(spark: SparkSession, d: str) -> DataFrame:
    rows = _edges(spark, d).withColumn("relation", F.substring("neighbour", 7, 1))
    return R.budgeted(rows, "entity", "relation", [F.desc("score"), F.desc("weight"), F.col("neighbour")], 1, 8)


@query("""SELECT p_brand AS cluster, arg_max(p_partkey, struct_pack(a := p_size > 45, b := length(p_name), c := -p_partkey)) AS canonical FROM part GROUP BY 1""")
def win05_canonical_choice(spark: SparkSession, d: str) -> DataFrame:
    rank = F.struct((F.col("p_size") > 45).alias("a"), F.length("p_name").alias("b"), (-F.col("p_partkey")).alias("c"))
    return table(spark, d, "part").groupBy(F.col("p_brand").alias("cluster")).agg(F.max_by("p_partkey", rank).alias("canonical"))


@query("""WITH t AS (SELECT DISTINCT l_suppkey, year(l_shipdate) AS y FROM lineitem)
SELECT l_suppkey AS entity, array_to_string(list_slice(list(y ORDER BY y DESC), 1, 3), ',') AS newest FROM t GROUP BY 1""")
def win06_newest_three(spark: SparkSession, d: str) -> DataFrame:
    years = F.slice(F.sort_array(F.collect_set(F.year("l_shipdate")), asc=False), 1, 3)
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("entity"))
    return rows.agg(F.array_join(years.cast("array<string>"), ",").alias("newest"))


@query("""SELECT s_suppkey, n, CAST(row_number() OVER (ORDER BY n DESC NULLS LAST, s_suppkey) AS INT) AS place FROM supplier LEFT JOIN (
SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_quantity > 49 AND l_discount > 0.09 GROUP BY 1) ON l_suppkey = s_suppkey ORDER BY place LIMIT 30""")
def srt01_nulls_last(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "lineitem").filter("l_quantity > 49 AND l_discount > 0.09D").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"))
    rows = table(spark, d, "supplier").select("s_suppkey").join(counts, "s_suppkey", "left")
    page = rows.orderBy(F.desc_nulls_last("n"), "s_suppkey").limit(30)
    return page.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last("n"), "s_suppkey")))


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 20 OFFSET 40")
def srt02_page(spark: SparkSession, d: str) -> DataFrame:
    return R.paged(table(spark, d, "part").select("p_partkey", "p_name"), [F.col("p_name"), F.col("p_partkey")], page=3)


@query("""SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%STANDARD%' ORDER BY (p_type = 'STANDARD') DESC, p_type, p_partkey LIMIT 20""")
def srt03_exact_first(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").filter(F.col("p_type").ilike("%STANDARD%")).select("p_partkey", "p_type")
    return rows.orderBy((F.col("p_type") == "STANDARD").desc(), "p_type", "p_partkey").limit(20)


@query("""SELECT l_suppkey AS id, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, id LIMIT 15""")
def srt05_top_n(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "id").limit(15)


@query("SELECT s_suppkey AS id, 'supplier' AS kind FROM supplier UNION ALL SELECT c_custkey, 'customer' FROM customer")
def set01_union_all(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"))
    return a.unionByName(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind")))


@query("""SELECT n_nationkey AS id, 'both' AS side FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 1000)
AND n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -900) UNION ALL
SELECT n_nationkey, 'neither' FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 1000)
AND n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -900)""")
def set03_set_algebra(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"))
    a = table(spark, d, "supplier").filter("s_acctbal < 1000").select(F.col("s_nationkey").alias("id"))
    b = table(spark, d, "customer").filter("c_acctbal < -900").select(F.col("c_nationkey").alias("id"))
    both = ids.join(a, "id", "left_semi").join(b, "id", "left_semi").withColumn("side", F.lit("both"))
    return both.unionByName(ids.join(a, "id", "left_anti").join(b, "id", "left_anti").withColumn("side", F.lit("neither")))


@query("SELECT DISTINCT lang, source FROM documents")
def set04_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("lang", "source").distinct()


@query("""SELECT p_name, p_brand FROM (SELECT DISTINCT p_name, p_brand FROM part)""")
def set05_unique_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part")
    target = rows.filter("p_size <= 20").select("p_name", "p_brand").distinct()
    return R.merge_unique(target, rows.filter("p_size > 20").select("p_name", "p_brand"), ["p_name", "p_brand"])
