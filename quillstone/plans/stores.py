"""Snapshots, builds, sinks, ingestion, curation, and what the command line and the serving layer read of them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import graph, ingest, lifecycle, promote
from quillstone.operators import relational as R
from quillstone.operators.spread import pairs_within
from quillstone.plans.views import participants, programmed, table
from quillstone.schemas import DOCUMENT
from quillstone.sources import bronze, exports, sqlite
from quillstone.sources.build import Build
from quillstone.sources.workspace import shared_folder

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def _documents(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows as entity documents of the source 'lib'; columns give the fields that are not null."""
    fixed = {"_type": F.lit("entity"), "source_name": F.lit("lib"), "kind": F.lit("person"), "raw": F.lit("{}")} | columns
    return rows.select(*[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DOCUMENT])


def _parts(spark: SparkSession, d: str, name: Column | None = None) -> DataFrame:
    return _documents(table(spark, d, "part"), id=F.col("p_partkey").cast("string"), name=F.col("p_name") if name is None else name)


# --- Snapshots ---


@query("""SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, 'r1' AS run_id FROM part""")
def src01_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Written as JSON lines and read again; blank and broken lines between them count for nothing."""
    bucket = bronze.Bucket(spark, shared_folder(spark, "src01"))
    bucket.write_documents("lib", _parts(spark, d), "r1")
    broken = spark.createDataFrame([("",), ('{"_type": "ent',), ("[]",)], "value string")
    broken.write.mode("append").text(f"{bucket.path('lib', 'r1')}/records")
    return bucket.read("lib", ["r1"]).select("id", "name", "run_id")


@query("""SELECT p_brand AS source, 'r1' AS run_id, 'completed' AS status, count(*) AS record_count FROM part GROUP BY 1 UNION ALL SELECT 'Brand#0', 'r2', 'unknown', NULL""")
def src04_runs(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot's manifest tells its state; one without a manifest is unknown [SRC-02, SRC-03, SRC-04]."""
    bucket = bronze.Bucket(spark, shared_folder(spark, "src04"))
    docs, p = _parts(spark, d), table(spark, d, "part")
    for row in p.select("p_brand").distinct().collect():  # a source each: a handful
        ids = p.filter(F.col("p_brand") == row.p_brand).select(F.col("p_partkey").cast("string").alias("id"))
        bucket.write_documents(row.p_brand, docs.join(ids, "id").select(*docs.columns), "r1")
    docs.limit(0).write.json(f"{bucket.path('Brand#0', 'r2')}/records")
    return bucket.runs().select("source", "run_id", "status", "record_count")


@query("""SELECT unnest(['r1', 'r3']) AS run_id, false AS replay UNION ALL SELECT unnest(['r1', 'r2', 'r3']), true""")
def src05_loadable_runs(spark: SparkSession, d: str) -> DataFrame:
    """Completed and unknown runs are loaded; a replay takes failed ones too."""
    bucket = bronze.Bucket(spark, shared_folder(spark, "src05"))
    docs = _documents(table(spark, d, "region"), id=F.col("r_name"))
    bucket.write_documents("lib", docs, "r1")
    try:
        bucket.write_documents("lib", docs.withColumn("name", F.raise_error(F.lit("broken off")).cast("string")), "r2")
    except Exception:  # what the source raised: the manifest says so
        pass
    docs.write.json(f"{bucket.path('lib', 'r3')}/records")
    rows = [(r, replay) for replay in (False, True) for r in bucket.loadable("lib", replay)]
    return spark.createDataFrame(rows, "run_id string, replay boolean")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size > 25 THEN p_type ELSE p_name END AS name, CASE WHEN p_size > 25 THEN 'r2' ELSE 'r1' END AS run_id FROM part""")
def src06_latest_documents(spark: SparkSession, d: str) -> DataFrame:
    """Of each id the document of the latest run that has it."""
    bucket = bronze.Bucket(spark, shared_folder(spark, "src06"))
    bucket.write_documents("lib", _parts(spark, d), "r1")
    p = table(spark, d, "part").filter("p_size > 25")
    bucket.write_documents("lib", _documents(p, id=F.col("p_partkey").cast("string"), name=F.col("p_type")), "r2")
    return bucket.latest("lib", bucket.loadable("lib")).select("id", "name", "run_id")


@query("""SELECT n_name AS name, n_nationkey % 5 = 0 AS good FROM nation""")
def src07_segments(spark: SparkSession, d: str) -> DataFrame:
    """Names that would leave their folder, or hold signs that no path may, are refused."""
    said = F.when(F.col("n_nationkey") % 5 == 0, F.col("n_name")).otherwise(F.try_element_at(F.array(F.concat("n_name", F.lit("/x")), F.lit(".."), F.concat(F.lit("a\\"), "n_name"), F.concat("n_name", F.lit("\n"))), (F.col("n_nationkey") % 5).cast("int")))
    return table(spark, d, "nation").select(F.col("n_name").alias("name"), bronze.is_segment(said).alias("good"))


@query("""SELECT '{"_type":"entity","id":"' || p_partkey || '","source_name":"lib","name":"' || p_name || '","kind":"person","raw":"{}"}' AS value FROM part""")
def src08_tagged_json(spark: SparkSession, d: str) -> DataFrame:
    return bronze.tagged_json(_parts(spark, d))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN false WHEN 3 THEN o_orderkey % 8 = 3 ELSE date_diff('day', o_orderdate, TIMESTAMP '1998-01-01') >= CASE o_orderkey % 4 WHEN 1 THEN 7 ELSE 365 END END AS due FROM orders""")
def src21_due(spark: SparkSession, d: str) -> DataFrame:
    """A static source is never due, one that never ran is; then the cadence decides, and an unknown one never does."""
    k = F.col("o_orderkey")
    cadence = F.when(k % 4 == 0, "static").when(k % 4 == 1, "weekly").when(k % 4 == 2, "yearly").otherwise("odd")
    last = F.when(k % 8 != 3, F.col("o_orderdate"))
    return table(spark, d, "orders").select("o_orderkey", bronze.is_due(cadence, last, F.lit(datetime(1998, 1, 1, tzinfo=timezone.utc)).cast("timestamp")).alias("due"))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS name, 'person' AS kind FROM part""")
def src22_single_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """One run of several: ids of runs sort by time."""
    bucket = bronze.Bucket(spark, shared_folder(spark, "src22"))
    old, new = (bronze.new_run_id(datetime(2026, 1, day, tzinfo=timezone.utc)) for day in (1, 2))
    bucket.write_documents("lib", _parts(spark, d), old)
    bucket.write_documents("lib", _parts(spark, d, F.col("p_type")), new)
    return bucket.read("lib", [max(bucket.loadable("lib"))]).select("id", "name", "kind")


# --- Builds and sinks ---


@query("""SELECT p_partkey, p_name, p_size FROM part""")
def src09_table_scan(spark: SparkSession, d: str) -> DataFrame:
    """Through relational databases and back: batched inserts, then a scan in ranges of the key [SRC-09, SRC-10, SRC-11]."""
    path, rows = shared_folder(spark, "src09"), table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    sqlite.write_table(rows, path, "part", "p_partkey")
    return sqlite.read_table(spark, path, "part", rows.schema, "p_partkey")


@query("""SELECT p_partkey AS id, 'second' AS build, (SELECT count(*) FROM part) AS n FROM part""")
def src12_builds(spark: SparkSession, d: str) -> DataFrame:
    """A second build takes over from the first; a third without rows is refused, and a failed one changes nothing [SRC-12..14, SRC-23]."""
    build = Build(spark, shared_folder(spark, "src12"))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"))
    for name in ("first", "second"):
        build.run(lambda name=name: {"t": rows.withColumn("build", F.lit(name))}, refuse_empty="t")
    for bad in (rows.filter("id < 0"), rows.select(F.raise_error(F.lit("broken off")).cast("long").alias("id"))):
        try:
            build.run(lambda bad=bad: {"t": bad.withColumn("build", F.lit("third"))}, refuse_empty="t")
        except Exception:  # refused, or failed: the pointer must not have moved
            pass
    return build.table("t").withColumn("n", F.lit(build.manifest()["rows"]["t"]).cast("long"))


@query("""SELECT 'Part' AS label, CAST(p_partkey AS VARCHAR) AS id, count(l_partkey) AS degree FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL""")
def src15_graph_tables(spark: SparkSession, d: str) -> DataFrame:
    """Vertices and edges, written and read again by way of the pointer."""
    root = shared_folder(spark, "src15")
    vertices = table(spark, d, "part").select(F.lit("Part").alias("label"), F.col("p_partkey").cast("string").alias("id"))
    edges = table(spark, d, "lineitem").select(F.lit("LISTS").alias("type"), F.col("l_orderkey").alias("from"), F.col("l_partkey").cast("string").alias("to"))
    exports.write_graph(vertices, edges, root)
    vertices, edges = exports.read_graph(spark, root)
    n = edges.groupBy(F.col("to").alias("id")).agg(F.count("*").alias("degree"))
    return vertices.select("label", "id").join(n, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


@query("""SELECT a.p_partkey AS a, b.p_partkey AS b, CAST(a.p_size = b.p_size AS INT) AS label FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_partkey < b.p_partkey""")
def src17_labelled_pairs(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark, "src17")
    rows = table(spark, d, "part").select("p_name", "p_partkey", "p_size")
    rows = pairs_within(rows, ["p_name"], "p_partkey")
    label = (F.col("p_size_a") == F.col("p_size_b")).cast("int").alias("label")
    exports.write_labelled(rows.select(F.col("p_partkey_a").alias("a"), F.col("p_partkey_b").alias("b"), label), path)
    return exports.read_labelled(spark, path, "a long, b long, label int")


@dataclass(frozen=True)
class _Settings:
    auto: float = 0.9
    review: float = 0.5
    name: str = "default"


@query("""SELECT 'saved' AS which, 0.8 AS auto, 0.5 AS review, 'part' AS name UNION ALL SELECT 'absent', 0.9, 0.5, 'default'""".replace("0.8", "0.8::DOUBLE").replace("0.9", "0.9::DOUBLE").replace("0.5", "0.5::DOUBLE"))
def src18_settings(spark: SparkSession, d: str) -> DataFrame:
    """Settings as saved; the defaults where there is no file."""
    path = f"{shared_folder(spark, 'src18')}/settings.json"
    exports.save_settings(spark, path, _Settings(auto=0.8, name="part"))
    saved, absent = (exports.load_settings(spark, p, _Settings()) for p in (path, f"{path}.none"))
    rows = [(which, s.auto, s.review, s.name) for which, s in (("saved", saved), ("absent", absent))]
    return spark.createDataFrame(rows, "which string, auto double, review double, name string")


# --- Ingestion ---


@query("""SELECT DISTINCT p_name AS label, 'person' AS kind, count(*) OVER (PARTITION BY p_name) AS records FROM part""")
def ing05_entities(spark: SparkSession, d: str) -> DataFrame:
    """Documents of one name are records of one entity, whose id follows from kind and key [ING-05, STR-29, STR-31]."""
    records = ingest.records_of(_parts(spark, d).withColumn("run_id", F.lit("r1")))
    rows = records.groupBy("entity_id", "kind").agg(F.min("name").alias("label"), F.count("*").alias("records"))
    return rows.select("label", "kind", "records")


@query("""SELECT 'lib' AS source, CAST(p_partkey AS VARCHAR) AS external_id, sha256(p_name || chr(0) || '' || chr(0) || '{}') AS hash, 'r1' AS last_run FROM part""")
def ing01_preload(spark: SparkSession, d: str) -> DataFrame:
    records = ingest.records_of(_parts(spark, d).withColumn("run_id", F.lit("r1"))).withColumnRenamed("run_id", "last_run")
    return lifecycle.preload(records).drop("entity_id")


@query("""SELECT p_partkey AS id, CASE WHEN p_size <= 20 OR p_size % 2 = 0 THEN 'decided' ELSE 'open' END AS status, CASE WHEN p_size <= 20 THEN 'absent' WHEN p_size % 2 = 0 THEN 'same' ELSE 'changed' END AS change FROM part""")
def ing04_mention_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A mention whose content changed is resolved anew; the others keep what was decided."""
    p = table(spark, d, "part")
    runs = {"first_run": F.lit("r1"), "last_run": F.lit("r1")}
    old = p.select(F.col("p_partkey").alias("id"), F.lit("decided").alias("status"), F.sha2("p_name", 256).alias("hash")).withColumns(runs)
    text = F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.col("p_type"))
    new = p.filter("p_size > 20").select(F.col("p_partkey").alias("id"), F.lit("open").alias("status"), F.sha2(text, 256).alias("hash"), F.lit("r2").alias("run_id"))
    return ingest.upsert(old, new, ["id"], ["status"]).select("id", "status", "change")


@query("""WITH s AS (SELECT o_custkey AS id, max(o_orderdate) AS seen FROM orders GROUP BY 1) SELECT c_custkey AS id, CASE WHEN seen IS NULL OR seen < TIMESTAMP '1996-01-01' THEN TIMESTAMP '1996-01-01' ELSE seen END AS last_ingested FROM customer LEFT JOIN s ON id = c_custkey""")
def ing07_touched(spark: SparkSession, d: str) -> DataFrame:
    base = F.lit("1996-01-01 00:00:00").cast(table(spark, d, "orders").schema["o_orderdate"].dataType)
    entities = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), base.alias("last_ingested"))
    return ingest.touched(entities, table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("at")))


@query("""SELECT p_brand AS source, CAST(p_partkey AS VARCHAR) AS external_id, CASE WHEN p_size > 25 THEN 'r2' ELSE 'r1' END AS last_run FROM part""")
def ing08_confirmed(spark: SparkSession, d: str) -> DataFrame:
    """Only a run that completed moves what it saw; one that failed afterwards leaves all as it is."""
    p = table(spark, d, "part")
    key = [F.col("p_brand").alias("source"), F.col("p_partkey").cast("string").alias("external_id")]
    rows = lifecycle.confirmed(p.select(*key, F.lit("r1").alias("last_run")), p.filter("p_size > 25").select(*key), "r2", True)
    return lifecycle.confirmed(rows, p.select(*key), "r3", False)


@query("""SELECT o_custkey % 10 AS source, count(*) AS records, count(*) FILTER (o_orderstatus <> 'F') AS unconfirmed FROM orders GROUP BY 1""")
def agg19_unconfirmed_records(spark: SparkSession, d: str) -> DataFrame:
    """Records whose last run is not a completed one of their source."""
    orders = table(spark, d, "orders")
    source = (F.col("o_custkey") % 10).alias("source")
    runs = orders.select(source, F.col("o_orderstatus").alias("run_id")).distinct().withColumn("status", F.when(F.col("run_id") == "F", "completed").otherwise("failed"))
    return ingest.unconfirmed(orders.select(source, F.col("o_orderstatus").alias("last_run")), runs)


@query("""SELECT 'good' AS run_id, 'completed' AS status, count(*) AS seen, NULL AS error FROM part UNION ALL SELECT 'bad', 'failed', CAST(7 AS BIGINT), 'broken off' """)
def ing09_runs(spark: SparkSession, d: str) -> DataFrame:
    """A run ends completed with its counts, or failed with what it had got to."""

    def good() -> dict[str, int]:
        return {"seen": table(spark, d, "part").count()}

    def bad() -> dict[str, int]:
        error = RuntimeError("broken off")
        error.counts = {"seen": 7}
        raise error

    rows = [lifecycle.run(work, name, "lib") for name, work in (("good", good), ("bad", bad))]
    return spark.createDataFrame([(r["run_id"], r["status"], r["seen"], r["error"]) for r in rows], "run_id string, status string, seen long, error string")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS external_id, p_type AS name, (SELECT count(DISTINCT p_type) FROM part) AS entities FROM part""")
def ing10_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """All runs replayed, oldest first, failed ones too; the tables are taken over in one step [ING-10, ING-12, CLI-10]."""
    root = shared_folder(spark, "ing10")
    bucket, target = bronze.Bucket(spark, f"{root}/raw"), Build(spark, f"{root}/silver")
    bucket.write_documents("lib", _parts(spark, d), "r1")
    bucket.write_documents("lib", _parts(spark, d, F.col("p_type")), "r2")
    count = lambda t: {"totals": t["entities"].agg(F.count("*").alias("entities"))}
    lifecycle.rebuilt(spark, bucket, target, ["lib"], passes={"places": count})
    return target.table("records").select("external_id", "name").crossJoin(F.broadcast(target.table("totals")))


@query("""SELECT 'places' AS pass, 0 AS place UNION ALL SELECT 'merge', 1 UNION ALL SELECT 'recordings', 2""")
def ing12_derived_order(spark: SparkSession, d: str) -> DataFrame:
    """Passes run in the order in which they depend on each other, however they are given."""
    seen: list[str] = []

    def step(name: str):
        return lambda tables: (seen.append(name), {name: tables["part"]})[1]

    made = lifecycle.derived({"part": table(spark, d, "part")}, {n: step(n) for n in ("recordings", "places", "merge")})
    assert set(made) == {"part", *seen}
    return spark.createDataFrame([(n, k) for k, n in enumerate(seen)], "pass string, place int")


# --- Curation ---


def _silver(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Suppliers and customers as persons (odd suppliers double the even one before), nations as places they claim."""
    s, c, n = (table(spark, d, t) for t in ("supplier", "customer", "nation"))
    k = F.col("s_suppkey")
    entities = s.select(k.alias("id"), F.lit("person").alias("kind"), F.col("s_name").alias("label"), F.when(k % 2 == 1, k - 1).alias("canonical"))
    entities = entities.unionByName(n.select((F.col("n_nationkey") + 10**9).cast("long").alias("id"), F.lit("place").alias("kind"), F.col("n_name").alias("label"), F.lit(None).cast("long").alias("canonical")))
    claims = s.select(k.alias("id"), k.alias("subject"), F.lit("based_in").alias("predicate"), (F.col("s_nationkey") + 10**9).cast("long").alias("object"), F.lit(None).cast("string").alias("value"), F.lit("lib").alias("source"))
    records = s.select(k.alias("id"), k.alias("entity"), F.lit("lib").alias("source"), F.concat(F.lit("x"), k - k % 2).alias("external_id"))
    runs = spark.createDataFrame([("r1", "lib", "completed")], "run_id string, source string, status string")
    return {"entities": entities, "claims": claims, "records": records, "runs": runs, "sources": spark.createDataFrame([(1, "lib")], "id long, name string")}


def _counts(spark: SparkSession, d: str) -> DataFrame:
    """Evidence of persons: here their balance stands for pages about them."""
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("root"), F.floor("s_acctbal").alias("sitelinks"))
    return rows.select("root", *[F.lit(0).alias(c) for c in ("concerts", "recordings", "credits", "works", "programmes")], "sitelinks")


_RULES = promote.EvidenceRules(min_concerts=1, min_recordings=1, min_credits=1, min_sitelinks=2000, min_referrers=2)
_KEPT = """WITH k AS (SELECT s_suppkey AS root FROM supplier WHERE s_suppkey % 2 = 0 AND s_acctbal >= 2000),
c AS (SELECT min(s_suppkey) AS id, s_suppkey - s_suppkey % 2 AS root, CAST(s_nationkey + 1000000000 AS BIGINT) AS object FROM supplier GROUP BY 2, 3), p AS (SELECT object FROM c JOIN k USING (root) GROUP BY 1 HAVING count(DISTINCT root) >= 2)"""


@query(f"""{_KEPT} SELECT root AS node FROM k UNION ALL SELECT object FROM p""")
def gld04_seeds(spark: SparkSession, d: str) -> DataFrame:
    """People with enough evidence, and the places that two of them share."""
    t = _silver(spark, d)
    heads = t["entities"].filter("canonical is null").select("id", "kind")
    claims = promote.collapse_claims(t["claims"], t["entities"], _RULES)
    kept = promote.evidenced(heads.filter("kind = 'person'").select(F.col("id").alias("root")), _counts(spark, d), _RULES)
    return promote.kept_entities(kept, claims, heads, _RULES)


@query(f"""{_KEPT} SELECT id, root AS subject, object FROM c WHERE root IN (SELECT root FROM k) AND object IN (SELECT object FROM p)""")
def gld07_claims(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.promoted(_silver(spark, d), _counts(spark, d), _RULES)["claims"].select("id", "subject", "object")


@query(f"""{_KEPT} SELECT s_suppkey AS id, s_suppkey AS entity, 'x' || s_suppkey AS external_id FROM supplier WHERE s_suppkey IN (SELECT root FROM k)""")
def gld09_records(spark: SparkSession, d: str) -> DataFrame:
    """Records point at the root; of two that are then the same the first stays."""
    return lifecycle.promoted(_silver(spark, d), _counts(spark, d), _RULES)["records"].select("id", "entity", "external_id")


@query(f"""{_KEPT}, v AS (SELECT root AS id FROM k UNION ALL SELECT object FROM p) SELECT v.id, CASE WHEN v.id < 1000000000 THEN 'person' ELSE 'place' END AS kind, (SELECT count(*) FROM v) AS n FROM v""")
def gld15_promote(spark: SparkSession, d: str) -> DataFrame:
    """The whole set of curated tables, built and taken over; entities point nowhere [GLD-14, GLD-15]."""
    build = Build(spark, shared_folder(spark, "gld15"))
    found = build.run(lambda: lifecycle.promoted(_silver(spark, d), _counts(spark, d), _RULES), refuse_empty="entities")
    rows = build.table("entities").filter("canonical is null")
    return rows.select("id", "kind", F.lit(found["rows"]["entities"]).cast("long").alias("n"))


# --- Snapshot of neighbourhoods ---

_SHARED = """WITH p AS (SELECT DISTINCT l_orderkey AS event, l_suppkey AS entity FROM lineitem), s AS (SELECT x.entity AS node, y.entity AS neighbour, count(*) AS weight FROM p x JOIN p y ON x.event = y.event AND x.entity <> y.entity GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, neighbour) AS place, count(*) OVER (PARTITION BY node) AS total FROM s)"""


@query(f"""{_SHARED} SELECT node, neighbour, weight, CAST(place AS INT) AS place, total FROM r WHERE place <= 6""")
def grf13_neighbourhood_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """All entities' pages in one job, built as one table that replaces the one before."""
    build = Build(spark, shared_folder(spark, "grf13"))
    pairs = graph.shared_pairs(participants(spark, d), "event", "entity")
    both = pairs.select(F.col("a").alias("node"), F.col("b").alias("neighbour"), F.col("shared").alias("weight"))
    both = both.unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("neighbour"), F.col("shared").alias("weight")))
    total = both.groupBy("node").agg(F.count("*").alias("total"))
    pages = R.capped(both, ["node"], [F.desc("weight"), F.col("neighbour")], 6).join(total, "node")
    build.run(lambda: {"connections": pages})
    return build.table("connections").select("node", "neighbour", "weight", "place", "total")


# --- What the serving layer and the command line read ---


@query("""SELECT 'entities' AS what, CAST('supplier' AS VARCHAR) AS which, count(*) AS n FROM supplier UNION ALL SELECT 'entities', 'customer', count(*) FROM customer UNION ALL SELECT 'claims', '', count(*) FROM supplier
UNION ALL SELECT 'records', p_brand, count(*) FROM part GROUP BY 2 UNION ALL SELECT 'mentions', o_orderstatus, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'linked', '', count(*) FROM supplier WHERE s_suppkey % 2 = 1""")
def api01_stats(spark: SparkSession, d: str) -> DataFrame:
    s, c, p, o = (table(spark, d, t) for t in ("supplier", "customer", "part", "orders"))
    counted = lambda rows, what, which: rows.groupBy(F.lit(what).alias("what"), which.cast("string").alias("which")).agg(F.count("*").alias("n"))
    out = counted(s, "entities", F.lit("supplier")).unionByName(counted(c, "entities", F.lit("customer"))).unionByName(counted(s, "claims", F.lit("")))
    out = out.unionByName(counted(p, "records", F.col("p_brand"))).unionByName(counted(o, "mentions", F.col("o_orderstatus")))
    return out.unionByName(counted(s.filter("s_suppkey % 2 = 1"), "linked", F.lit("")))


@query("""SELECT n_name AS genre, s_name AS person, coalesce(n, 0) AS concerts, CAST(row_number() OVER (PARTITION BY n_name ORDER BY coalesce(n, 0) DESC, s_name) AS INT) AS place FROM supplier JOIN nation ON n_nationkey = s_nationkey
LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey QUALIFY place <= 20""")
def api07_genre_people(spark: SparkSession, d: str) -> DataFrame:
    """The people of each genre, the most played first."""
    counts = participants(spark, d).groupBy(F.col("entity").alias("s_suppkey")).agg(F.count("*").alias("concerts"))
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(counts, "s_suppkey", "left")
    rows = rows.select(F.col("n_name").alias("genre"), F.col("s_name").alias("person"), F.coalesce("concerts", F.lit(0)).alias("concerts"))
    return R.capped(rows, ["genre"], [F.desc("concerts"), F.col("person")], 20)


@query("""SELECT o_orderkey AS id, c_name AS title, count(DISTINCT l_partkey) AS works, count(DISTINCT l_suppkey) AS credits FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2 ORDER BY works DESC, id LIMIT 20""")
def api16_recordings(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.countDistinct("l_partkey").alias("works"), F.countDistinct("l_suppkey").alias("credits"))
    rows = table(spark, d, "orders").filter("o_orderstatus = 'F'").join(counts, "o_orderkey").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return R.paged(rows.select(F.col("o_orderkey").alias("id"), F.col("c_name").alias("title"), "works", "credits"), [F.desc("works"), F.col("id")])


@query("""SELECT s_suppkey AS id, s_name AS label, coalesce(n, 0) AS concerts FROM supplier LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey
WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) ORDER BY concerts DESC, label LIMIT 20""")
def api20_soloists(spark: SparkSession, d: str) -> DataFrame:
    """People whose claims name the profession, the most played first."""
    professions = table(spark, d, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"))
    rows = table(spark, d, "supplier").join(professions, "s_nationkey", "left_semi")
    counts = participants(spark, d).groupBy(F.col("entity").alias("s_suppkey")).agg(F.count("*").alias("concerts"))
    rows = rows.join(counts, "s_suppkey", "left").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"), F.coalesce("concerts", F.lit(0)).alias("concerts"))
    return R.paged(rows, [F.desc("concerts"), F.col("label")])


@query("""SELECT s_name AS subject, 'based_in' AS predicate, n_name AS object, r_name AS source FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE s_acctbal > 5000""")
def cli01_claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims with labels in place of ids."""
    rows = table(spark, d, "supplier").filter("s_acctbal > 5000").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(F.col("s_name").alias("subject"), F.lit("based_in").alias("predicate"), F.col("n_name").alias("object"), F.col("r_name").alias("source"))


@query("""SELECT s_name AS ensemble, count(DISTINCT l_orderkey) AS concerts FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey WHERE s_suppkey % 3 > 0 GROUP BY 1""")
def cli02_unanchored_ensembles(spark: SparkSession, d: str) -> DataFrame:
    """Ensembles without an authority id, with their concerts."""
    counts = participants(spark, d).groupBy(F.col("entity").alias("s_suppkey")).agg(F.count("*").alias("concerts"))
    rows = table(spark, d, "supplier").filter("s_suppkey % 3 > 0").join(counts, "s_suppkey", "left")
    return rows.select(F.col("s_name").alias("ensemble"), F.coalesce("concerts", F.lit(0)).alias("concerts"))


@query("""SELECT p_name AS title, p_brand AS composer, count(l_orderkey) AS mentions FROM part LEFT JOIN lineitem ON l_partkey = p_partkey WHERE p_type = 'ECONOMY' GROUP BY p_partkey, 1, 2""")
def cli04_works(spark: SparkSession, d: str) -> DataFrame:
    counts = programmed(spark, d).groupBy(F.col("work").alias("p_partkey")).agg(F.sum("times").alias("mentions"))
    rows = table(spark, d, "part").filter("p_type = 'ECONOMY'").join(counts, "p_partkey", "left")
    return rows.select(F.col("p_name").alias("title"), F.col("p_brand").alias("composer"), F.coalesce("mentions", F.lit(0)).alias("mentions"))


@query("""SELECT l_orderkey AS mention, l_linenumber AS line, p_name AS candidate, round(l_discount, 2) AS score FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'N' AND l_discount > 0.04""")
def cli05_review(spark: SparkSession, d: str) -> DataFrame:
    """Mentions that wait for a person, with the nearest work."""
    rows = table(spark, d, "lineitem").filter("l_returnflag = 'N' and l_discount > 0.04D").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(F.col("l_orderkey").alias("mention"), F.col("l_linenumber").alias("line"), F.col("p_name").alias("candidate"), F.round("l_discount", 2).alias("score"))


@query("""SELECT n_name AS genre, r_name AS parent, count(s_suppkey) AS people FROM nation JOIN region ON r_regionkey = n_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2""")
def cli07_genres(spark: SparkSession, d: str) -> DataFrame:
    """Genres with their parent and how many people claim them."""
    people = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("people"))
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(people, "n_nationkey", "left")
    return rows.select(F.col("n_name").alias("genre"), F.col("r_name").alias("parent"), F.coalesce("people", F.lit(0)).alias("people"))


@query("""SELECT p_brand AS source, 'r1' AS latest, 'completed' AS status, count(*) AS records, true AS due FROM part GROUP BY 1""")
def adm01_sources(spark: SparkSession, d: str) -> DataFrame:
    """What an administrator sees of the sources: the latest run, its state and size, and whether it is due again."""
    bucket = bronze.Bucket(spark, shared_folder(spark, "adm01"))
    p = table(spark, d, "part")
    docs = _parts(spark, d)
    for row in p.select("p_brand").distinct().collect():
        ids = p.filter(F.col("p_brand") == row.p_brand).select(F.col("p_partkey").cast("string").alias("id"))
        bucket.write_documents(row.p_brand, docs.join(ids, "id").select(*docs.columns), "r1")
    runs = bucket.runs()
    last = runs.groupBy("source").agg(F.max_by(F.struct("run_id", "status", "record_count", "started_at"), "run_id").alias("r")).select("source", "r.*")
    due = bronze.is_due(F.lit("daily"), F.col("started_at").cast("timestamp"), F.current_timestamp() + F.expr("interval 2 days"))
    return last.select("source", F.col("run_id").alias("latest"), "status", F.col("record_count").alias("records"), due.alias("due"))

