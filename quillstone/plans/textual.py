"""Scalar functions over the driver's text, JSON and date columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import text as X
from quillstone.operators.spread import pairs_within
from quillstone.plans.views import table
from quillstone.sources import connectors

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return keep


_KEY = r"substr(trim(regexp_replace(regexp_replace(lower(strip_accents({})), '[^\p{{L}}\p{{N}}_\s]', '{}', 'g'), '\s+', ' ', 'g')), 1, 512)"
_TURNED = "CASE WHEN strpos({0}, ',') > 0 THEN trim(concat_ws(' ', trim(substr({0}, strpos({0}, ',') + 1)), trim(substr({0}, 1, strpos({0}, ',') - 1)))) ELSE trim({0}) END"
_LINE = "split_part(text, chr(10), 1)"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("line"), "text")


@query(f"SELECT doc_id, md5({_KEY.format(_TURNED.format('trim(' + _LINE + ')'), '')}) AS key FROM documents")
def str01_dedup_key(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).select("doc_id", F.md5(X.dedup_key(F.col("line"))).alias("key"))


@query(f"SELECT doc_id, md5({_KEY.format(_LINE, ' ')}) AS key FROM documents")
def str02_title_key(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).select("doc_id", F.md5(X.title_key(F.col("line"))).alias("key"))


@query("""SELECT a.p_partkey AS a, b.p_partkey AS b, CASE WHEN a.p_size = b.p_size THEN 0 WHEN abs(a.p_size - b.p_size) <= 2 THEN 1
WHEN abs(a.p_size - b.p_size) <= 10 THEN 2 ELSE 3 END AS level FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_partkey < b.p_partkey""")
def str06_year_level(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_name", "p_partkey", "p_size")
    rows = pairs_within(rows, ["p_name"], "p_partkey")
    return rows.select(F.col("p_partkey_a").alias("a"), F.col("p_partkey_b").alias("b"), X.year_level(F.col("p_size_a"), F.col("p_size_b")).alias("level"))


@query("""SELECT p_partkey, regexp_replace(lower(p_brand || '-' || p_type), '[^a-z0-9]', '', 'g') AS key FROM part""")
def str08_alnum_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", X.alnum_key(F.concat_ws("-", "p_brand", "p_type")).alias("key"))


@query("""SELECT p_partkey, array_to_string([CAST(x AS VARCHAR) FOR x IN range(p_size, p_size + p_partkey % 5 + 1)], ',') || ',' || (p_partkey % 50)
AS members FROM part""")
def str13_catalogue_members(spark: SparkSession, d: str) -> DataFrame:
    code = F.concat(F.col("p_size"), F.lit("-"), F.col("p_size") + F.col("p_partkey") % 5, F.lit(", "), F.col("p_partkey") % 50)
    return table(spark, d, "part").select("p_partkey", F.array_join(X.catalogue_members(code), ",").alias("members"))


@query("""SELECT l_partkey, min(strftime(l_shipdate, '%Y-%m-%d')) AS earliest FROM lineitem GROUP BY 1""")
def str19_earliest_date(spark: SparkSession, d: str) -> DataFrame:
    """Dates of mixed precision: those of even line numbers lose the day, but a finer date beats its prefix."""
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    rows = table(spark, d, "lineitem").select("l_partkey", day.alias("day"))
    rows = rows.unionByName(rows.select("l_partkey", F.substring("day", 1, 7).alias("day")))
    return rows.groupBy("l_partkey").agg(F.min_by("day", X.date_order(F.col("day"))).alias("earliest"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def str21_iso_date(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", X.iso_date(F.date_format("o_orderdate", "dd-MM-yyyy")).alias("iso"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m')
ELSE strftime(o_orderdate, '%Y') END AS iso FROM orders""")
def str22_long_date(spark: SparkSession, d: str) -> DataFrame:
    forms = [F.date_format("o_orderdate", f) for f in ("d MMMM yyyy", "MMMM yyyy", "yyyy")]
    text = F.when(F.col("o_orderkey") % 3 == 0, forms[0]).when(F.col("o_orderkey") % 3 == 1, forms[1]).otherwise(forms[2])
    return table(spark, d, "orders").select("o_orderkey", X.long_date(text).alias("iso"))


@query("""SELECT o_orderkey, CASE 9 + o_orderkey % 3 WHEN 11 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 10 THEN strftime(o_orderdate, '%Y-%m')
ELSE strftime(o_orderdate, '%Y') END AS cut FROM orders""")
def str23_truncate_time(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("+"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, d, "orders").select("o_orderkey", X.truncate_time(text, 9 + F.col("o_orderkey") % 3).alias("cut"))


@query("SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '[0-9]{4}', 0), '') AS INT) AS year FROM documents")
def str24_first_year(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.first_year(F.col("text")).alias("year"))


@query("""SELECT p_partkey, (p_size % 4) * 60 + p_size AS minutes FROM part""")
def str25_minutes(spark: SparkSession, d: str) -> DataFrame:
    hours = F.col("p_size") % 4
    text = F.concat(F.when(hours > 0, F.concat(hours, F.lit(" h "))).otherwise(""), F.col("p_size"), F.lit("-"), F.col("p_size") + 5, F.lit(" minutes"))
    return table(spark, d, "part").select("p_partkey", X.minutes(text).alias("minutes"))


@query("SELECT doc_id, regexp_matches(lang, '^[A-Za-z]{2,3}$') AS good, false AS bad FROM documents")
def str27_language_tag(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents")
    return rows.select("doc_id", X.is_language_tag(F.col("lang")).alias("good"), X.is_language_tag(F.concat("lang", F.lit("_x"))).alias("bad"))


@query("""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'),
'(?s)<[^>]*>', ' ', 'g') AS t FROM pages)
SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
'&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g'))) AS plain FROM a""")
def str28_plain_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(X.plain_text(F.col("html"))).alias("plain"))


@query("SELECT page_id, sha256(coalesce(url, '') || chr(0) || coalesce(html, '') || chr(0)) AS hash FROM pages")
def str29_content_hash(spark: SparkSession, d: str) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return table(spark, d, "pages").select("page_id", X.content_hash(F.col("url"), F.col("html"), nothing).alias("hash"))


#: RFC 4122's name space for domain names.
DNS = "6ba7b8109dad11d180b400c04fd430c8"


@query(f"""WITH h AS (SELECT p_partkey, sha1(unhex('{DNS}') || CAST(p_name AS BLOB)) AS x FROM part)
SELECT p_partkey, x[1:8] || '-' || x[9:12] || '-5' || x[14:16] || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', x[17:17]), 1)
|| x[18:20] || '-' || x[21:32] AS id FROM h""")
def str31_name_uuid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", X.name_uuid(DNS, F.col("p_name")).alias("id"))


@query("""SELECT c_nationkey AS entity, string_agg(DISTINCT upper(c_mktsegment), ',' ORDER BY upper(c_mktsegment)) AS spellings FROM customer GROUP BY 1""")
def agg14_distinct_spellings(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("entity"))
    both = F.flatten(F.array(F.array_sort(F.collect_set("c_mktsegment")), F.array_sort(F.collect_set(F.lower("c_mktsegment")))))
    return rows.agg(F.array_join(X.distinct_spellings(both), ",").alias("spellings"))


@query("""SELECT p_partkey, round(log2((p_size / 60.0) / (1 - p_size / 60.0)), 6) AS bits, round(p_size / 60.0, 6) AS back FROM part""")
def mth01_log_odds(spark: SparkSession, d: str) -> DataFrame:
    bits = X.log_odds(F.col("p_size") / 60.0)
    return table(spark, d, "part").select("p_partkey", F.round(bits, 6).alias("bits"), F.round(X.probability(bits), 6).alias("back"))


@query("""WITH f AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_partkey, round(greatest(-6, least(6, log2(20.0 / n))), 6) AS bits, round_even(log2(20.0 / n) / 0.25, 0) * 0.25 + 0.0 AS quarter FROM f""")
def mth02_rarity_bits(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    bits = X.rarity_bits(F.lit(20.0), F.col("n"))
    return rows.select("l_partkey", F.round(bits, 6).alias("bits"), X.quarter_bits(bits).alias("quarter"))


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events""")
def jsn01_payload_fields(spark: SparkSession, d: str) -> DataFrame:
    raw = F.try_parse_json("props")
    return table(spark, d, "events").select(
        "event_id", F.try_variant_get(raw, "$.k", "bigint").alias("k"), F.try_variant_get(raw, "$.missing", "string").alias("missing")
    )


@query(r"""SELECT page_id, len(list_distinct(regexp_extract_all(html, '(?i)\bhref="([^"#]*)', 1))) AS links FROM pages""")
def con20_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.size(connectors.links(F.col("html"), "")).cast("long").alias("links"))


@query(r"""WITH l AS (SELECT DISTINCT unnest(regexp_extract_all(html, '(?i)\bhref="([^"#]*)', 1)) AS url FROM pages)
SELECT url FROM l WHERE url NOT IN (SELECT url FROM pages WHERE url IS NOT NULL)""")
def con21_frontier(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    found = pages.select(F.explode(connectors.links(F.col("html"), "")).alias("url"))
    return connectors.frontier(found, pages)


@query(r"""SELECT page_id, len(list_filter(regexp_extract_all(html, '(?is)<tr\b[^>]*>(.*?)</tr>', 1), lambda x: regexp_matches(x, '(?is)<t[dh]\b[^>]*>.*?</t[dh]>'))) AS n_rows FROM pages""")
def con15_table_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.size(connectors.table_rows(F.col("html"))).cast("long").alias("n_rows"))
