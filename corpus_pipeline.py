"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; its result is written and
read again before the next stage, so that a lost executor never costs more than a stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.deploy import ship
from quillstone.llm import linededup, mixing, ngramjoin, packing, quality
from quillstone.llm.common import Scratch, table, word_count


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    return quality.keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; those of which no word is left go."""
    rows = linededup.line_dedup(docs).filter((F.col("n_cut") == 0) | (word_count(F.col("text")) > 0))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of lowest doc_id."""
    return ngramjoin.one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("mixing sources", mix_sources),
    ("packing", pack),
]

#: Compression, MinHash and subset sums are nothing that SQL can express: the tests hold run() against a brute-force twin.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    ship(spark)
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        after = scratch.save(stage(spark, docs, sf_dir), f"stage{i}")
        scratch.drop(before)
        docs = before = after
    return docs
