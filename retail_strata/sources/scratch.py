"""A folder every executor can reach, for tables a query writes and reads back."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.  Only a local session, where
    driver and executors share one disk, may go without that setting."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/retail_strata/{purpose}-{uuid.uuid4().hex}"
