"""Gives this package to executors that do not have it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the session's Python files, once a context; Spark takes them to every executor."""
    context = spark.sparkContext
    if getattr(context, "_quillstone_shipped", False):
        return
    top = Path(__file__).resolve().parent
    if top.suffix == ".zip" or not top.is_dir():
        return  # this very module runs out of shipped sources
    archive = f"{tempfile.mkdtemp(prefix='quillstone-')}/quillstone.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, f"quillstone/{path.relative_to(top)}")
    context.addPyFile(archive)
    context._quillstone_shipped = True
