"""Sends this package to Python workers, which may run where it isn't installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once a context."""
    context = spark.sparkContext
    if getattr(context, "_gleanery_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="gleanery-")) / "gleanery.zip"  # the driver serves it from here
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(path))
    context._gleanery_shipped = True
