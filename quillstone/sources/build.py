"""Versioned builds: tables are written to a folder of their own; one small pointer file then names it current."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from quillstone.sources.bronze import Files


class Build:
    """A set of tables under root [SRC-12, SRC-13, SRC-14, SRC-23]. Readers see the last build that ended well."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def manifest(self) -> dict | None:
        text = self.files.read(f"{self.root}/current.json")
        return json.loads(text) if text else None

    def table(self, name: str) -> DataFrame:
        found = self.manifest()
        if found is None:
            raise FileNotFoundError(f"nothing was built in {self.root}")
        return self.spark.read.parquet(f"{self.root}/{found['version']}/{name}")

    def run(self, make: Callable[[], dict[str, DataFrame]], refuse_empty: str | None = None) -> dict:
        """Writes make()'s tables, then moves the pointer; on an error, or if refuse_empty has no rows, the pointer stays."""
        version = f"v-{uuid.uuid4().hex}"
        started = datetime.now(timezone.utc).isoformat()
        rows = {}
        for name, df in make().items():
            df.write.parquet(f"{self.root}/{version}/{name}")
            rows[name] = self.spark.read.parquet(f"{self.root}/{version}/{name}").count()
        if refuse_empty and not rows.get(refuse_empty):
            raise ValueError(f"{refuse_empty} is empty: the build is not taken over")
        found = {"version": version, "status": "completed", "started_at": started, "rows": rows}
        self.files.write(f"{self.root}/current.json", json.dumps(found))
        return found
