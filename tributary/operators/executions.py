"""Spark's own execution records: pairing, job contexts, metrics.

Ids of executions, jobs and stages are unique inside one application only: records with a column ``app_id``
are kept apart by it. Records of a single application may leave it out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

APP = "app_id"


def _keys(df: DataFrame, *names: str) -> list[str]:
    return [APP, *names] if APP in df.columns else [*names]


def _paired(starts: DataFrame, ends: DataFrame, name: str) -> DataFrame:
    key = _keys(ends, name)
    started = starts.select(*key, F.col("ts").alias("start_ts"), F.lit(True).alias("started"))
    return ends.select(*key, F.col("ts").alias("end_ts")).join(started, key, "left").select(
        *key, "start_ts", "end_ts", F.coalesce("started", F.lit(False)).alias("had_start")
    )


def pair_executions(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Every end, with its start if there was one. A start without end is dropped."""
    return _paired(starts, ends, "execution_id")


def pair_jobs(jobs: DataFrame, ends: DataFrame) -> DataFrame:
    """Every job end with its start, and the context that the job ends: see ``job_context``."""
    key = _keys(ends, "job_id")
    contexts = job_context(jobs).select(*key, "kind", "context_id")
    return _paired(jobs, ends, "job_id").join(contexts, key, "left")


def job_context(jobs: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """The execution a job belongs to: by its own properties, else by the active job's, else none."""
    key = _keys(jobs, "job_id")
    if active is not None:
        known = active.select(*key, F.col("execution_id").alias("active_id"))
        jobs = jobs.join(known, key, "left").withColumn(
            "execution_id", F.coalesce("execution_id", "active_id")
        ).drop("active_id")
    by_sql = F.col("execution_id").isNotNull()
    return jobs.select(
        *key,
        "execution_id",
        F.when(by_sql, "sql").otherwise("rdd").alias("kind"),
        F.when(by_sql, F.col("execution_id")).otherwise(F.col("job_id")).alias("context_id"),
    )


def _metrics(df: DataFrame, keys: set[str]) -> list[str]:
    keys = {APP, *keys}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys]


def _sums(names: list[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def job_stages(jobs: DataFrame) -> DataFrame:
    return jobs.select(*_keys(jobs, "job_id"), F.explode(F.array_distinct("stage_ids")).alias("stage_id"))


def metrics_per_job(jobs: DataFrame, tasks: DataFrame) -> DataFrame:
    """Sum every numeric task column per job. Tasks are summed per stage first, so the join meets one
    row per stage however many tasks it ran."""
    names = _metrics(tasks, {"stage_id"})
    stage = _keys(tasks, "stage_id")
    stages = tasks.groupBy(*stage).agg(*_sums(names))
    return job_stages(jobs).join(stages, stage).groupBy(*_keys(jobs, "job_id")).agg(*_sums(names))


def metrics_per_execution(jobs: DataFrame, tasks: DataFrame, active: DataFrame | None = None) -> DataFrame:
    per_job = metrics_per_job(jobs, tasks)
    names = _metrics(per_job, {"job_id"})
    key = _keys(jobs, "job_id")
    contexts = job_context(jobs, active).where(F.col("kind") == "sql").select(*key, "execution_id")
    return contexts.join(per_job, key).groupBy(*_keys(jobs, "execution_id")).agg(*_sums(names))
