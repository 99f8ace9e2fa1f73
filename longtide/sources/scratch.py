"""Folders for tables that an operation stages."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that spark.checkpoint.dir names.

    Where that is unset, below a temporary one if all executors are on this
    machine, as in tests; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        root = "file://" + tempfile.mkdtemp(prefix="longtide-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/archive/{name}-{uuid.uuid4().hex}"
