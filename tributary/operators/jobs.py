"""The jobs that edges are stamped with, and the services they run on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.documents import edge_document, job_document, service_document

JOB_COLUMNS = ("source_url", "description", "service")


def current_jobs(jobs: DataFrame) -> DataFrame:
    """One row per job name. Jobs carry no time, so of several rows the greatest stays."""
    last = F.max(F.struct(*JOB_COLUMNS)).alias("last")
    return jobs.groupBy("name").agg(last).select("name", "last.*")


def document_of() -> Column:
    return job_document(F.col("name"), *[F.col(c) for c in JOB_COLUMNS])


def job_documents(jobs: DataFrame) -> DataFrame:
    return current_jobs(jobs).select("name", document_of().alias("document"))


def with_ids(jobs: DataFrame, listed: DataFrame) -> DataFrame:
    """Add ``job_id`` from the jobs that the catalog lists (name, job_id); of several with one name the least counts,
    and a job that is not listed yet has none."""
    ids = listed.groupBy("name").agg(F.min("job_id").alias("job_id"))
    return jobs.join(ids, "name", "left")


def service_documents(jobs: DataFrame) -> DataFrame:
    services = jobs.select("service").where(F.col("service").isNotNull()).distinct()
    return services.withColumn("document", service_document(F.col("service")))


def stamp_jobs(edges: DataFrame, jobs: DataFrame) -> DataFrame:
    """Add ``job_id`` by ``job_key``; an edge whose job isn't known keeps null. ``jobs`` has one row per
    configured application; Spark broadcasts it if it is small and splits a job with very many edges if it
    is not."""
    return edges.join(jobs.select("job_key", "job_id"), "job_key", "left")


def edge_documents(stamped: DataFrame) -> DataFrame:
    parts = ("from_type", "from_id", "to_type", "to_id", "job_id", "columns")
    return stamped.select("from_id", "to_id", edge_document(*[F.col(c) for c in parts]).alias("document"))
