"""A place for files that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir or what setCheckpointDir() was given; only where neither is set and all runs on this machine, below a temporary folder."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="gleanery-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
