"""Edge tables.

A stream adds one folder of already upserted edges per micro-batch, so a batch costs what it brings,
not what is stored; a repeated batch rewrites its own folder. Readers fold the folders with the same
upsert, and ``compact_edges`` writes that fold as a new table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.operators.edges import upsert
from tributary.schemas import EDGE

COLUMNS = [field.name for field in EDGE.fields]


def write_edges(edges: DataFrame, path: str) -> None:
    """A whole edge table, in folders by type of its two ends."""
    edges.select(*COLUMNS).write.partitionBy("from_type", "to_type").mode("errorifexists").parquet(path)


def write_batch(edges: DataFrame, path: str, batch_id: int) -> None:
    edges.select(*COLUMNS).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EDGE).parquet(path).select(*COLUMNS)


def current_edges(spark: SparkSession, *paths: str) -> DataFrame:
    """One current edge per pair of entities, over stored tables and batch folders alike."""
    edges = read_edges(spark, paths[0])
    for path in paths[1:]:
        edges = edges.unionByName(read_edges(spark, path))
    return upsert(edges)


def compact_edges(spark: SparkSession, target: str, *paths: str) -> None:
    """Fold tables and batch folders into a new table; ``target`` must not be among them."""
    write_edges(current_edges(spark, *paths), target)
