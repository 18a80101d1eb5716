"""The JSON documents a catalog takes: edges, the jobs that make them, and their services."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the catalog's document format.
EDGE_SOURCE = "SparkLineage"
SERVICE_TYPE = "Spark"
JOB_ENTITY_TYPE = "pipeline"


def entity_reference(entity_type: Column, entity_id: Column) -> Column:
    return F.struct(entity_type.alias("type"), entity_id.alias("id"))


def edge_document(
    from_type: Column, from_id: Column, to_type: Column, to_id: Column, job_id: Column, columns: Column
) -> Column:
    """An edge without a job leaves ``pipeline`` out."""
    details = F.struct(
        F.when(job_id.isNotNull(), entity_reference(F.lit(JOB_ENTITY_TYPE), job_id)).alias("pipeline"),
        F.lit(EDGE_SOURCE).alias("source"),
        columns.alias("columnsLineage"),
    )
    edge = F.struct(
        entity_reference(from_type, from_id).alias("fromEntity"),
        entity_reference(to_type, to_id).alias("toEntity"),
        details.alias("lineageDetails"),
    )
    return F.to_json(F.struct(edge.alias("edge")))


def job_document(name: Column, source_url: Column, description: Column, service: Column) -> Column:
    """A missing URL stays as JSON null; a missing or empty description is left out."""
    head = [name.alias("name"), source_url.alias("sourceUrl")]
    tail = [service.alias("service")]
    keep_nulls = {"ignoreNullFields": "false"}
    return F.when(
        F.coalesce(description, F.lit("")) == "", F.to_json(F.struct(*head, *tail), keep_nulls)
    ).otherwise(F.to_json(F.struct(*head, description.alias("description"), *tail), keep_nulls))


def service_document(name: Column) -> Column:
    config = F.struct(F.struct(F.lit(SERVICE_TYPE).alias("type")).alias("config"))
    return F.to_json(
        F.struct(name.alias("name"), F.lit(SERVICE_TYPE).alias("serviceType"), config.alias("connection"))
    )
