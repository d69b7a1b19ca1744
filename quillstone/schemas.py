"""Schemas of raw documents and of the normalised tables."""

from pyspark.sql import types as T

CLAIM = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("predicate", "object_kind", "object_label", "value", "object_wikidata_id")]
)

#: One line of a snapshot: an entity or a work mention; raw is kept as JSON text.
DOCUMENT = T.StructType(
    [
        T.StructField("_type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("composer", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("claims", T.ArrayType(CLAIM)),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.StringType()),
        T.StructField("finished_at", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)
