"""Structured Streaming over snapshots: an extension, as the batch engine has no stream of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillstone.operators.ingest import records_of, upsert
from quillstone.schemas import DOCUMENT
from quillstone.sources.build import Build


def documents(spark: SparkSession, root: str, source: str) -> DataFrame:
    """New documents of a source as runs arrive."""
    rows = spark.readStream.schema(DOCUMENT).json(f"{root}/{source}/*/records")
    return rows.withColumn("run_id", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/records/", 1)).filter("_type IS NOT NULL")


def upsert_records(docs: DataFrame, target: Build, checkpoint: str) -> StreamingQuery:
    """Each micro-batch is merged into the build's records table as a new version; a repeated batch changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        whole = F.struct(*[c for c in batch.columns])
        last = batch.groupBy("source_name", "_type", "id").agg(F.max_by(whole, "run_id").alias("d")).select("d.*")
        new = records_of(last)
        empty = new.limit(0).withColumns({"first_run": F.col("run_id"), "last_run": F.col("run_id")}).drop("run_id")
        old = target.table("records") if target.manifest() else empty
        merged = upsert(old, new, ["source", "external_id"], ["name", "url", "raw", "language"]).drop("change")
        target.run(lambda: {"records": merged})

    return docs.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str, by: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by event-time window, final once the watermark has passed."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), *by).agg(F.count("*").alias("n"))


def latest_by_key(rows: DataFrame, key: list[str], order: str, sink: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Hands each batch's last row of every key to sink."""

    def one(batch: DataFrame, _: int) -> None:
        sink(batch.groupBy(*key).agg(F.max_by(F.struct(*batch.columns), order).alias("r")).select("r.*"))

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
