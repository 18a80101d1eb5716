"""Where jobs keep tables, checkpoints and streams during a run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``. Only a session on one machine, as in tests,
    may leave that setting out and gets a temporary folder; a cluster without it is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if master.split("[")[0] != "local":
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return tempfile.mkdtemp(prefix=f"{name}-")
