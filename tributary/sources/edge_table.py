"""An edge table of folders under a manifest, and versions of the catalog that edges are resolved with.

A stream's run adds a folder of upserted edges per micro-batch, under its own name. A batch that runs again
replaces its folder; a run that starts over, with a new checkpoint, retires the folders of the runs before it
with its first batch, so nothing is left of batches it does not have. Compaction folds the live folders into one
and retires them in the same change. Folders that are no longer live stay until ``retired`` names them for
removal: readers that began before go on unharmed.

A catalog version is a folder with the entries and their lookup index, published when both are whole. Streams
read the newest at every micro-batch; the version a batch used is in the manifest, and a batch that runs again
uses that one.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tributary.operators.edges import upsert
from tributary.operators.lookup import lookup_index
from tributary.schemas import EDGE
from tributary.sources import manifest
from tributary.sources.edge_store import COLUMNS

COMPACTED = "compacted"


def _write(edges: DataFrame, path: str, name: str) -> str:
    folder = f"data/{name}/{uuid.uuid4().hex}"
    edges.select(*COLUMNS).write.parquet(f"{path}/{folder}")
    return folder


def batch_version(spark: SparkSession, path: str, run: str, batch: int) -> int | None:
    """The catalog version a batch used that has been written already."""
    _, rows = manifest.live(spark, path)
    return next((r.version for r in rows if (r.run, r.batch) == (run, batch)), None)


def add_batch(edges: DataFrame, path: str, run: str, batch: int, version: int | None = None, replaces: bool = True) -> None:
    """Write a batch's folder and make it live. With ``replaces`` the first batch of a run retires whatever other
    runs wrote, their compacted folders too; else it stands beside them."""
    spark = edges.sparkSession
    folder = _write(edges, path, f"{run}/{batch:012d}")
    at, rows = manifest.live(spark, path)
    known = any(r.run == run for r in rows)
    kept = [r for r in rows if (r.run, r.batch) != (run, batch) and (known or not replaces)]
    manifest.publish(spark, path, at, [*kept, manifest.entry(folder, run, batch, version)])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the live folders; only these are opened."""
    _, rows = manifest.live(spark, path)
    parts = [spark.read.schema(EDGE).parquet(f"{path}/{r.folder}").select(*COLUMNS) for r in rows]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], EDGE)


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """One current edge per pair of entities."""
    return upsert(read_table(spark, path))


def compact_table(spark: SparkSession, path: str) -> None:
    """Fold the live folders of each run into one. A batch that is added meanwhile makes the change fail, which
    leaves the table as it was; the fold may be tried again."""
    at, rows = manifest.live(spark, path)
    folded = []
    for run in sorted({r.run for r in rows}):
        own = [r for r in rows if r.run == run]
        if len(own) == 1:
            folded += own
            continue
        parts = [spark.read.schema(EDGE).parquet(f"{path}/{r.folder}").select(*COLUMNS) for r in own]
        folder = _write(upsert(reduce(DataFrame.unionAll, parts)), path, f"{run}/{COMPACTED}")
        folded.append(manifest.entry(folder, run))
    if folded != rows:
        manifest.publish(spark, path, at, folded)


def retired(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Folders that were live once and are not in the newest ``keep`` versions: those that may be removed."""
    newest = manifest.newest(spark, path)
    folders = lambda versions: {r.folder for v in versions for r in manifest.live(spark, path, v)[1]}
    return sorted(folders(range(newest + 1)) - folders(range(max(0, newest + 1 - keep), newest + 1)))


# Versions of the catalog


def publish_catalog(catalog: DataFrame, path: str) -> int:
    """Write a catalog and its lookup index, then make them the newest version; returns its number."""
    spark = catalog.sparkSession
    at = manifest.newest(spark, path)
    folder = f"data/{uuid.uuid4().hex}"
    catalog.write.parquet(f"{path}/{folder}/catalog")
    lookup_index(spark.read.parquet(f"{path}/{folder}/catalog")).write.parquet(f"{path}/{folder}/index")
    manifest.publish(spark, path, at, [manifest.entry(folder)])
    return at + 1


def read_catalog_version(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, DataFrame, DataFrame]:
    """(version, index, catalog), the newest without ``version``."""
    at, rows = manifest.live(spark, path, version)
    if not rows:
        raise ValueError(f"no catalog has been published below {path}")
    folder = f"{path}/{rows[0].folder}"
    return at, spark.read.parquet(f"{folder}/index"), spark.read.parquet(f"{folder}/catalog")
