"""The folder that all machines of a cluster share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where that is unset a temporary folder for a local master, as in tests, and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return path or tempfile.mkdtemp(prefix="tidemark-")
