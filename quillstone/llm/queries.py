"""The ten corpus operators over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import fingerprint, linededup, mixing, ngramjoin, packing, quality, secrets, tokencount, toxicity, urls
from quillstone.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, model).withColumn("held_out", held_out)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_join(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_cut")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS BIGINT) AS weight,
         source_size * 2 AS cap
  FROM s),
r AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (
              ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            AS rate
  FROM w),
c AS (SELECT *, max(CASE WHEN cap >= rate * weight THEN rate END) OVER () AS common FROM r),
t AS (
  SELECT source, source_size, least(coalesce(common * weight, CAST(cap AS DOUBLE)), CAST(cap AS DOUBLE)) AS target
  FROM c),
q AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size, doc_id NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS b
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       greatest(0, least(size, CAST(round(target) AS BIGINT) - b))
       + greatest(0, least(size, CAST(round(target) AS BIGINT) - b - source_size)) AS taken
FROM q
"""


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_fingerprints": op2_fingerprints,
    "op3_secret_scan": op3_secret_scan,
    "op4_packing": op4_packing,
    "op5_ngram_join": op5_ngram_join,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_url_filters": op9_url_filters,
    "op10_quality_rules": op10_quality_rules,
}

ORACLE_SQL: dict[str, str] = {"op7_mixing": OP7_SQL}
