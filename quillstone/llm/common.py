"""Shared helpers: reading tables, scratch tables, and batch-wise Python operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: White space wherever words are cut: space, tab, line feed, vertical tab, form feed, return.
WHITESPACE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

#: Rows handed to a Python function at once: few, so that long texts do not pile up in a worker.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only for a local session that sets none."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = getattr(spark, "_quillstone_scratch", None)
        if root is None:
            root = spark._quillstone_scratch = "file://" + tempfile.mkdtemp(prefix="quillstone-")
    return root.rstrip("/")


class Scratch:
    """Intermediate tables in the shared folder. Writing one cuts lineage: a lost executor costs no earlier stage."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, f"{scratch_root(spark)}/quillstone/{name}-{uuid.uuid4().hex}"
        self.count, self.paths = 0, []

    def save(self, df: DataFrame, label: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{label}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.paths.append(path)
        return out

    def drop(self, df: DataFrame | None) -> None:
        """Deletes a saved table that no later plan reads."""
        path = getattr(df, "_scratch_path", None)
        if path:
            self._delete(path)

    def keep(self, *frames: DataFrame) -> None:
        """Deletes all saved tables but these: plans made from others must have been written by now."""
        for path in set(self.paths) - {df._scratch_path for df in frames}:
            self._delete(path)

    def _delete(self, path: str) -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        if path in self.paths:
            self.paths.remove(path)


def word_count(text: Column) -> Column:
    """Number of words (runs of anything but WHITESPACE); 0 for null."""
    bare = F.trim(text, F.lit(WHITESPACE))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) == 0, F.lit(0).cast("long")).otherwise(
        F.size(F.split(bare, WORD_GAP, -1)).cast("long")
    )


def map_slices(
    df: DataFrame, schema: T.StructType, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]]
) -> DataFrame:
    """df's rows through a Python function of column lists, SLICE_ROWS rows at a time.

    make() runs once a task and returns the function. Rows are never collected beyond a slice.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield pa.RecordBatch.from_pydict(step(batch.slice(at, SLICE_ROWS).to_pydict()), schema=arrow)

    return df.mapInArrow(run, schema)
