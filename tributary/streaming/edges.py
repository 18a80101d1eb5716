"""Run events as a stream: edges to one table, rejected events to another.

Every event is handled alone when it arrives, so the query keeps no state. Each micro-batch resolves
its distinct names against a lookup index, and writes its own folder in both tables: running a batch again
gives the same files. ``start_edges`` takes an index that was written once; ``start_table_edges`` reads the
newest version of the catalog at every micro-batch, so an entry that arrives while the stream runs is found from
the next batch on.

A batch is not cached: its documents are read once for the rejects and once for the edges. Plans over a cached batch
do not share their exchanges, and made the named sides anew for every use; the cache held all documents, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.operators.edges import column_edges, column_set, upsert
from tributary.operators.events import rejected_events
from tributary.sources.edge_store import write_batch
from tributary.sources.edge_table import add_batch, batch_version, read_catalog_version


def current_batch_edges(events: DataFrame, index: DataFrame, catalog: DataFrame) -> DataFrame:
    """Upserted edges with their columns, ready for the edge table."""
    edges = column_edges(events, index, catalog)
    return upsert(
        edges.select(
            "from_type", "from_id", "to_type", "to_id", "event_time", "event_id", "in_pos", "out_pos",
            column_set(F.col("column_pairs")).alias("columns"),
        )
    )


def write_rejects(batch: DataFrame, path: str, batch_id: int) -> None:
    rejects = rejected_events(batch).select("event_id", "event_type", "event_time", "reason")
    rejects.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def start_rejects(events: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The rejected events alone: no index, no catalog, no edges."""
    return (
        events.writeStream.foreachBatch(lambda batch, batch_id: write_rejects(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_edges(
    events: DataFrame,
    index: DataFrame,
    catalog: DataFrame,
    edges_path: str,
    rejects_path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(current_batch_edges(batch, index, catalog), edges_path, batch_id)
        write_rejects(batch, rejects_path, batch_id)

    return (
        events.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_table_edges(
    events: DataFrame, catalog_path: str, table: str, rejects_path: str, checkpoint: str, run: str, replaces: bool = True, **trigger
) -> StreamingQuery:
    """Edges into a table under a manifest, each micro-batch resolved with the newest catalog below ``catalog_path``.
    ``run`` names what goes with one checkpoint: a run started over takes a new name, and with ``replaces`` retires
    what the runs before it wrote."""
    spark = events.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        version, index, catalog = read_catalog_version(spark, catalog_path, batch_version(spark, table, run, batch_id))
        write_rejects(batch, f"{rejects_path}/run={run}", batch_id)
        add_batch(current_batch_edges(batch, index, catalog), table, run, batch_id, version, replaces)

    return (
        events.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
