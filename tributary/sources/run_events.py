"""Run events from files, as a table or as a stream.

``read_run_events`` reads rows that already have the library's schema. Producers' own documents, one JSON text
per line, go through ``from_documents``: run ids are strings there (``run_key``), and an event has no id, so it
gets the hash of its text: the same document is the same event however often it is read. A text is parsed once and
its datasets are built once, whatever reads them.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.once import built_once
from tributary.schemas import DATASET, RUN_EVENT, WRITTEN_EVENT


def read_run_events(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    return spark.read.schema(RUN_EVENT).format(file_format).load(path)


def stream_run_events(
    spark: SparkSession, path: str, file_format: str = "json", max_files: int | None = None
) -> DataFrame:
    """``max_files`` bounds what one micro-batch takes of a backlog."""
    reader = spark.readStream.schema(RUN_EVENT).format(file_format)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def _datasets(written: str) -> Column:
    def fields(facets: Column) -> Column:
        return F.transform_values(facets["columnLineage"]["fields"], lambda _, field: field["inputFields"])

    return F.transform(
        written,
        lambda d: F.struct(
            d["namespace"].alias("namespace"), d["name"].alias("name"),
            d["facets"]["symlinks"]["identifiers"].alias("symlinks"), fields(d["facets"]).alias("column_lineage"),
        ),
    ).cast(f"array<{DATASET.simpleString()}>")


def from_documents(lines: DataFrame) -> DataFrame:
    """Run events and their ``run_key`` from JSON texts in ``value``. A text that is no document gives an event
    without a type, which the rejects then hold; an empty line gives none."""
    parsed = built_once(lines.where(F.trim("value") != ""), F.from_json("value", WRITTEN_EVENT).alias("e"), keep=("value",))
    run = F.col("e.run.runId")
    return built_once(
        parsed,
        F.xxhash64("value").alias("event_id"), F.col("e.eventType").alias("event_type"), F.col("e.eventTime").alias("event_time"),
        F.xxhash64(run).alias("run_id"), run.alias("run_key"), _datasets("e.inputs").alias("inputs"), _datasets("e.outputs").alias("outputs"),
    )


def read_event_documents(spark: SparkSession, path: str) -> DataFrame:
    return from_documents(spark.read.text(path))


def stream_event_documents(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    return from_documents((reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path))
