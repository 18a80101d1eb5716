"""Which folders of a table count: one small file per change, the newest one holds.

A change is a new version below ``manifest``, written by Spark's own file writer: its rows appear at once when
the job commits, and a version that exists already is an error for whoever comes second. Readers list the folder
names and read the newest version only; folders that it does not name are of no concern to them. The rows of a
version are as many as the table has live folders, which compaction keeps few.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession

SCHEMA = "folder string, run string, batch long, version long"


def newest(spark: SparkSession, path: str) -> int:
    """The newest complete version, -1 if there is none."""
    try:
        files = spark.read.text(f"{path}/manifest/*").inputFiles()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    return max((int(m.group(1)) for f in files if (m := re.search(r"/manifest/(\d+)/[^/]+$", f))), default=-1)


def live(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[Row]]:
    """(version, rows) of the newest manifest or of an earlier one."""
    at = newest(spark, path) if version is None else version
    if at < 0:
        return at, []
    return at, spark.read.schema(SCHEMA).json(f"{path}/manifest/{at:012d}").where("folder IS NOT NULL").collect()


def publish(spark: SparkSession, path: str, version: int, rows: list[Row]) -> None:
    """Make ``rows`` the manifest; ``version`` is the one they were made from. Fails if another change came first."""
    named = [(r.folder, r.run, r.batch, r.version) for r in rows] or [(None, None, None, None)]
    spark.createDataFrame(named, SCHEMA).coalesce(1).write.mode("errorifexists").json(f"{path}/manifest/{version + 1:012d}")


def entry(folder: str, run: str | None = None, batch: int | None = None, version: int | None = None) -> Row:
    return Row(folder=folder, run=run, batch=batch, version=version)
