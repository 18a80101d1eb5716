"""Execution records from Spark event logs, JSON lines, plain or zstd.

Every line is parsed once, with the fields of all records that are used; the event's name then tells them
apart. ``app_id`` is the log's name, as ids are unique inside one application only.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.once import built_once

# Names of events and fields are fixed values of Spark's event log.
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
SQL_END = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd"
JOB_START = "SparkListenerJobStart"
JOB_END = "SparkListenerJobEnd"
TASK_END = "SparkListenerTaskEnd"
ENVIRONMENT = "SparkListenerEnvironmentUpdate"
EVENTS = (SQL_START, SQL_END, JOB_START, JOB_END, TASK_END, ENVIRONMENT)
PACKED = r"\.(lz4|lzf|snappy)(\.inprogress|\.compact)?$|\.zstd\.(inprogress|compact)$"  # what Spark's text reader does not unpack
ROLLED = r"^(.*/eventlog_v2_[^/]+)/events_(\d+)_[^/]+?(\.compact)?$"

FIELDS = """
  `Event` STRING, `executionId` BIGINT, `time` BIGINT,
  `Job ID` BIGINT, `Submission Time` BIGINT, `Completion Time` BIGINT, `Stage IDs` ARRAY<BIGINT>,
  `Properties` STRUCT<`spark.sql.execution.id`: STRING>,
  `Stage ID` BIGINT,
  `Task Metrics` STRUCT<
    `Executor Run Time`: BIGINT,
    `Executor CPU Time`: BIGINT,
    `Input Metrics`: STRUCT<`Bytes Read`: BIGINT, `Records Read`: BIGINT>,
    `Output Metrics`: STRUCT<`Bytes Written`: BIGINT, `Records Written`: BIGINT>>,
  `Spark Properties` MAP<STRING, STRING>
"""


def _app_of(path: Column) -> Column:
    """The application of a log file: the folder of a rolling log, else the file's own name."""
    rolling = F.regexp_extract(path, r"/eventlog_v2_([^/]+)/[^/]+$", 1)
    single = F.regexp_extract(path, r"([^/]+?)(\.zstd)?(\.inprogress)?$", 1)
    return F.when(rolling != "", rolling).otherwise(single)


def superseded(files: list[str]) -> set[str]:
    """The files of rolling logs that a compacted file stands for: all up to its own number, other compacted ones
    included. It holds what is still wanted of them."""
    rolled = [(f, m.group(1), int(m.group(2)), bool(m.group(3))) for f in files if (m := re.match(ROLLED, f))]
    newest: dict[str, int] = {}
    for _, log, number, compact in rolled:
        if compact:
            newest[log] = max(number, newest.get(log, -1))
    return {f for f, log, number, compact in rolled if number < newest.get(log, -1) or (number == newest.get(log) and not compact)}


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """(value, app_id) of every line below ``path``. Where a rolling log has been compacted, the newest compacted file
    and those after it count. Logs in another compression than zstd, and compacted or unfinished ones in any, are
    refused: their lines would match nothing and the result would be empty without a word."""
    lines = spark.read.text(path, recursiveFileLookup=True)
    files = lines.inputFiles()
    gone = superseded(files)
    kept = [f for f in files if f not in gone]
    if packed := [f for f in kept if re.search(PACKED, f)]:
        raise ValueError(f"compressed event log, unpack it first: {packed[0]} ({len(packed)} files)")
    if gone:
        lines = spark.read.text([unquote(f) for f in kept])
    return lines.select("value", _app_of(F.col("_metadata.file_path")).alias("app_id"))


def records(lines: DataFrame) -> DataFrame:
    """The parsed lines of the events that are used. Other lines are not parsed; a broken line is none."""
    used = F.lit(False)
    for event in EVENTS:
        used = used | F.col("value").contains(event)
    others = [c for c in lines.columns if c != "value"]
    parsed = built_once(lines.where(used), F.from_json("value", FIELDS).alias("record"), keep=tuple(others))
    return parsed.where(F.col("record.Event").isin(*EVENTS)).select(*others, "record.*")


def _of(parsed: DataFrame, event: str, **columns: Column) -> DataFrame:
    app = ["app_id"] if "app_id" in parsed.columns else []
    return parsed.where(F.col("Event") == event).select(*app, *[c.alias(n) for n, c in columns.items()])


def _executions(parsed: DataFrame, event: str) -> DataFrame:
    return _of(parsed, event, execution_id=F.col("executionId"), ts=F.timestamp_millis("time"))


def sql_starts(parsed: DataFrame) -> DataFrame:
    return _executions(parsed, SQL_START)


def sql_ends(parsed: DataFrame) -> DataFrame:
    return _executions(parsed, SQL_END)


def _execution_of_job() -> Column:
    return F.col("Properties")["spark.sql.execution.id"].cast("bigint")


def job_starts(parsed: DataFrame) -> DataFrame:
    return _of(
        parsed, JOB_START, job_id=F.col("Job ID"), execution_id=_execution_of_job(), stage_ids=F.col("Stage IDs"),
        ts=F.timestamp_millis("Submission Time"),
    )


def job_ends(parsed: DataFrame) -> DataFrame:
    return _of(parsed, JOB_END, job_id=F.col("Job ID"), ts=F.timestamp_millis("Completion Time"))


def task_ends(parsed: DataFrame) -> DataFrame:
    metrics = F.col("Task Metrics")
    return _of(
        parsed, TASK_END,
        stage_id=F.col("Stage ID"),
        run_time_ms=metrics["Executor Run Time"],
        cpu_time_ns=metrics["Executor CPU Time"],
        bytes_read=metrics["Input Metrics"]["Bytes Read"],
        records_read=metrics["Input Metrics"]["Records Read"],
        bytes_written=metrics["Output Metrics"]["Bytes Written"],
        records_written=metrics["Output Metrics"]["Records Written"],
    )


def settings(parsed: DataFrame) -> DataFrame:
    """(app_id, key, value) of the applications' settings."""
    return parsed.where(F.col("Event") == ENVIRONMENT).select("app_id", F.explode("Spark Properties").alias("key", "value"))


def all_records(parsed: DataFrame) -> DataFrame:
    """Executions, jobs and tasks in one frame, in one pass: (app_id, record, id, execution_id, ts, stage_ids,
    records, bytes)."""
    kind = F.element_at(
        F.create_map(*[F.lit(x) for pair in (
            (SQL_START, "sql_start"), (SQL_END, "sql_end"), (JOB_START, "job_start"), (JOB_END, "job_end"), (TASK_END, "task_end")
        ) for x in pair]),
        F.col("Event"),
    )
    read = F.col("Task Metrics")["Input Metrics"]
    return parsed.where(F.col("Event") != ENVIRONMENT).select(
        "app_id", kind.alias("record"), F.coalesce("executionId", "Job ID", "Stage ID").alias("id"),
        _execution_of_job().alias("execution_id"),
        F.timestamp_millis(F.coalesce("time", "Submission Time", "Completion Time")).alias("ts"),
        F.col("Stage IDs").alias("stage_ids"), read["Records Read"].alias("records"), read["Bytes Read"].alias("bytes"),
    )
