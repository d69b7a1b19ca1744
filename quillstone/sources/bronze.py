"""Raw snapshots: {root}/{source}/{run_id}/ holds JSON lines and a manifest. All paths may be in any file system of Spark's."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.schemas import DOCUMENT, MANIFEST

#: Runs whose documents are loaded; replays also take failed ones.
LOADABLE = ("completed", "unknown")
#: Days after which a source is due again.
CADENCE_DAYS = {"daily": 1, "weekly": 7, "monthly": 30, "quarterly": 91, "yearly": 365}


def segment(value: str, field: str) -> str:
    """A path segment as it is, or ValueError: no separators, dots alone, or control characters [SRC-07]."""
    if not value or value in (".", "..") or any(c in "/\\" or ord(c) < 32 or ord(c) == 127 for c in value):
        raise ValueError(f"{field} is not a path segment: {value!r}")
    return value


def is_segment(value: Column) -> Column:
    """Whether segment() would take a value [SRC-07]; null is none."""
    return F.coalesce((value != "") & ~value.isin(".", "..") & ~value.rlike(r"[/\\\x00-\x1f\x7f]"), F.lit(False))


def new_run_id(now: datetime | None = None) -> str:
    """Sorts by time [SRC-22]."""
    now = now or datetime.now(timezone.utc)
    return now.strftime("%Y-%m-%dT%H%M%SZ-") + uuid.uuid4().hex[:8]


class Files:
    """Small sidecar files through Hadoop's file systems."""

    def __init__(self, spark: SparkSession) -> None:
        self.context = spark.sparkContext

    def _at(self, path: str):
        where = self.context._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.context._jsc.hadoopConfiguration()), where

    def read(self, path: str) -> str | None:
        fs, where = self._at(path)
        if not fs.exists(where):
            return None
        stream = fs.open(where)
        try:
            return str(self.context._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Replaces the file by a complete one: a reader finds the old text or the new one, never none."""
        _, part = self._at(f"{path}.{uuid.uuid4().hex}.part")
        fs, _ = self._at(path)
        stream = fs.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.replace(part, path)

    def replace(self, part, path: str) -> None:
        """Moves the file part over path in one step."""
        fs, where = self._at(path)
        options = self.context._jvm.org.apache.hadoop.fs.Options
        how = self.context._gateway.new_array(getattr(options, "Rename"), 1)
        how[0] = getattr(options, "Rename").OVERWRITE
        at = self.context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.context._jsc.hadoopConfiguration()
        )
        at.rename(fs.makeQualified(part), fs.makeQualified(where), how)

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def glob(self, pattern: str) -> list[str]:
        fs, where = self._at(pattern)
        return sorted(str(s.getPath()) for s in (fs.globStatus(where) or []))


class Bucket:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def path(self, source: str, run_id: str) -> str:
        return f"{self.root}/{segment(source, 'source')}/{segment(run_id, 'run_id')}"

    def write_documents(self, source: str, docs: DataFrame, run_id: str | None = None) -> str:
        """A snapshot with its manifest: running, then completed with a count, or failed with the error [SRC-02, SRC-03]."""
        run_id = run_id or new_run_id()
        at = self.path(source, run_id)
        stamp = lambda: datetime.now(timezone.utc).isoformat()
        manifest = {"source": source, "run_id": run_id, "status": "running", "started_at": stamp()}
        self.files.write(f"{at}/manifest.json", json.dumps(manifest))
        try:
            docs.write.json(f"{at}/records")
            manifest |= {"status": "completed", "record_count": self.spark.read.text(f"{at}/records").count()}
        except Exception as error:
            manifest |= {"status": "failed", "error": str(error)[:500]}
            raise
        finally:
            self.files.write(f"{at}/manifest.json", json.dumps(manifest | {"finished_at": stamp()}))
        return run_id

    def runs(self, source: str = "*") -> DataFrame:
        """Manifests, oldest run first; a snapshot without one has status unknown [SRC-04]."""
        found = [p.split("/")[-2:] for p in self.files.glob(f"{self.root}/{source}/*")]
        rows = []
        for name, run_id in found:
            text = self.files.read(f"{self.root}/{name}/{run_id}/manifest.json")
            known = json.loads(text) if text else {"status": "unknown"}
            rows.append([{"source": name, "run_id": run_id, **known}.get(f.name) for f in MANIFEST])
        return self.spark.createDataFrame(rows, MANIFEST).orderBy("source", "run_id")

    def loadable(self, source: str, replay: bool = False) -> list[str]:
        """Ids of runs to load, oldest first [SRC-05]."""
        states = (*LOADABLE, "failed") if replay else LOADABLE
        rows = self.runs(segment(source, "source")).filter(F.col("status").isin(*states))
        return [r.run_id for r in rows.select("run_id").orderBy("run_id").collect()]

    def read(self, source: str, run_ids: list[str]) -> DataFrame:
        """Documents of the runs with run_id; blank and broken lines are left out [SRC-01, SRC-22]."""
        paths = [f"{self.path(source, r)}/records" for r in run_ids]
        paths = [p for p in paths if self.files.exists(p)]
        if not paths:
            return self.spark.createDataFrame([], DOCUMENT).withColumn("run_id", F.lit(""))
        lines = self.spark.read.text(paths).withColumn("run_id", F.regexp_extract(F.input_file_name(), r"/([^/]+)/records/", 1))
        docs = lines.filter(F.trim("value") != "").withColumn("d", F.from_json("value", DOCUMENT, {"mode": "PERMISSIVE"}))
        return docs.filter(F.col("d._type").isNotNull()).select("d.*", "run_id")

    def latest(self, source: str, run_ids: list[str]) -> DataFrame:
        """Of each external id the document of the latest run that has it [SRC-06]."""
        docs = self.read(source, run_ids)
        whole = F.struct(*docs.columns)
        return docs.groupBy("source_name", "_type", "id").agg(F.max_by(whole, "run_id").alias("d")).select("d.*")


def tagged_json(docs: DataFrame) -> DataFrame:
    """(value): documents as JSON lines with their _type, absent fields left out [SRC-08]."""
    return docs.select(F.to_json(F.struct(*DOCUMENT.names), {"ignoreNullFields": "true"}).alias("value"))


def kind_of_snapshot(docs: DataFrame) -> DataFrame:
    """(run_id, kind): the type of a run's documents [SRC-04]."""
    return docs.groupBy("run_id").agg(F.min("_type").alias("kind"))


def is_due(cadence: Column, last_started: Column, now: Column) -> Column:
    """Never run: due, unless static; then due once the cadence has passed; an unknown cadence is never due [SRC-21]."""
    days = F.create_map(*[F.lit(x) for pair in CADENCE_DAYS.items() for x in pair])
    passed = F.unix_timestamp(now) - F.unix_timestamp(last_started) >= F.try_element_at(days, cadence) * 86400
    return F.when(cadence == "static", F.lit(False)).when(last_started.isNull(), True).otherwise(F.coalesce(passed, F.lit(False)))


def request_fingerprint(method: Column, url: Column, body: Column) -> Column:
    """Key of a mirrored page [SRC-20]."""
    return F.sha2(F.concat_ws("\0", method, url, F.coalesce(body, F.lit(""))), 256)


def fresh(fetched_at: Column, now: Column, seconds: int) -> Column:
    return F.unix_timestamp(now) - F.unix_timestamp(fetched_at) < seconds
