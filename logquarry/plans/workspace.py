"""Where stage outputs go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one the cluster shares (``spark.checkpoint.dir``).

    Only a local session may do without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="logquarry-")
    return f"{base.rstrip('/')}/logquarry/{name}-{uuid.uuid4().hex}"
