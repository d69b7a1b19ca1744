"""Append logs and upserts over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import ingest
from quillstone.plans.views import table

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return keep


@query("""SELECT user_id, event_type, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS event_id FROM events GROUP BY 1, 2""")
def src06_later_run_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").groupBy("user_id", "event_type")
    return rows.agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("""SELECT page_id, sha256('GET' || chr(0) || url || chr(0)) AS request FROM pages""")
def src20_request_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    from quillstone.sources.bronze import request_fingerprint

    return table(spark, d, "pages").select("page_id", request_fingerprint(F.lit("GET"), F.col("url"), F.lit(None).cast("string")).alias("request"))


@query("""WITH o AS (SELECT l_orderkey AS k, sha256(CAST(count(*) FILTER (l_linenumber <= 2) AS VARCHAR)) AS h, count(*) FILTER (l_linenumber <= 2) AS v FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
n AS (SELECT l_orderkey AS k, sha256(CAST(count(*) AS VARCHAR)) AS h, count(*) AS v FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1)
SELECT coalesce(o.k, n.k) AS external_id, CASE WHEN o.k IS NULL THEN n.v WHEN n.k IS NULL OR o.h = n.h THEN o.v ELSE n.v END AS name,
CASE WHEN o.k IS NULL THEN 'r2' ELSE 'r1' END AS first_run, CASE WHEN n.k IS NULL THEN 'r1' ELSE 'r2' END AS last_run,
CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NULL THEN 'absent' WHEN o.h <> n.h THEN 'changed' ELSE 'same' END AS change FROM o FULL JOIN n USING (k)""")
def ing02_upsert(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    hashed = lambda rows: rows.withColumn("hash", F.sha2(F.col("name").cast("string"), 256))
    key = F.col("l_orderkey").alias("external_id")
    old = hashed(lines.filter("l_linestatus = 'F'").groupBy(key).agg(F.count_if(F.col("l_linenumber") <= 2).alias("name")))
    old = old.withColumns({"first_run": F.lit("r1"), "last_run": F.lit("r1")})
    new = hashed(lines.filter("l_returnflag <> 'A'").groupBy(key).agg(F.count("*").alias("name"))).withColumn("run_id", F.lit("r2"))
    return ingest.upsert(old, new, ["external_id"], ["name"]).drop("hash")


@query("""SELECT doc_id % 40 AS subject, 'language' AS predicate, CAST(NULL AS VARCHAR) AS object, lang AS value, source FROM documents GROUP BY ALL""")
def ing03_claims_append_only(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(
        "n_chars", (F.col("doc_id") % 40).alias("subject"), F.lit("language").alias("predicate"), F.lit(None).cast("string").alias("object"),
        F.col("lang").alias("value"), "source",
    )
    old = rows.filter("n_chars < 1000").drop("n_chars").distinct()
    return ingest.append_claims(old, rows.drop("n_chars"))
