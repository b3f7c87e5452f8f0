"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Where that is unset, below a folder of our own if all runs on this machine
    (tests), else an error: executors elsewhere would not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_qirtas_paths", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = spark._qirtas_paths = "file://" + tempfile.mkdtemp(prefix="qirtas-files-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
