"""Lineage edges: both ends resolved, details attached, one current edge per pair of entities."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.names import column_fqn
from tributary.operators.events import (
    collapse,
    dataset_pairs,
    distinct_names,
    name_counts,
    named,
    named_sides,
    pair_sides,
    side_names,
)
from tributary.operators.lookup import first_hits, with_columns
from tributary.operators.skew import sliced_join

EDGE_KEY = ("from_type", "from_id", "to_type", "to_id")
ARRIVAL = ("event_time", "event_id", "in_pos", "out_pos")

# A lookup index, or what makes one for the names (table_name) that are asked.
Index = DataFrame | Callable[[DataFrame], DataFrame]


def _resolved(counts: DataFrame, index: Index) -> DataFrame:
    asked = distinct_names(counts)
    return first_hits(asked, index if isinstance(index, DataFrame) else index(asked))


def table_edges(events: DataFrame, refs: DataFrame, index: Index) -> DataFrame:
    """Edges of the long form, ``n_pairs`` calls each. ``events`` are those past the gate's type test;
    a pair exists only if both sides do, so the rest of the gate needs no check here.

    Distinct names are resolved once; references only meet the resolved ones.
    """
    sides = collapse(named(refs))
    names = name_counts(sides, F.col("n"))
    entities = _resolved(names, index).drop("fqn")
    found = sliced_join(sides, entities, ["table_name"], ["event_id", "side"], names)
    pairs = pair_sides(events, found, sides)
    return pairs.select(
        *[c for c in events.columns],
        F.col("in_entity_type").alias("from_type"),
        F.col("in_id").alias("from_id"),
        F.col("in_table_name").alias("from_name"),
        F.col("in_pos"),
        F.col("out_entity_type").alias("to_type"),
        F.col("out_id").alias("to_id"),
        F.col("out_table_name").alias("to_name"),
        F.col("out_pos"),
        "n_pairs",
    )


def _known_links(links: Column, columns: str, column: str) -> Column:
    return F.filter(links, lambda link: F.array_contains(F.col(columns), link[column]))


def _column_pairs(links: Column, source: str, target: str) -> Column:
    """Links as (fromColumns, toColumn) with full names; duplicates stay."""
    return F.transform(
        links,
        lambda link: F.struct(
            F.array(column_fqn(F.col(source + "fqn"), link["from_column"])).alias("fromColumns"),
            column_fqn(F.col(target + "fqn"), link["to_column"]).alias("toColumn"),
        ),
    )


def column_edges(events: DataFrame, index: Index, catalog: DataFrame) -> DataFrame:
    """Edges of nested events, each with the bag of its column pairs in ``column_pairs``.

    A link stays if both its columns exist. Each end tests its own column right after its join, so that no
    list of columns is shuffled with the pairs.
    """
    sides = named_sides(events)
    names = side_names(sides)
    entities = with_columns(_resolved(names, index), catalog)

    def end(prefix: str) -> DataFrame:
        return entities.select(
            F.col("table_name").alias(prefix + "name"),
            F.col("entity_type").alias(prefix + "type"),
            F.col("id").alias(prefix + "id"),
            F.col("fqn").alias(prefix + "fqn"),
            F.col("column_names").alias(prefix + "columns"),
        )

    spread = ["event_id", "in_pos", "out_pos"]
    joined = dataset_pairs(sides)
    for prefix, column in (("from_", "from_column"), ("to_", "to_column")):
        name = prefix + "name"
        counts = names.withColumnRenamed("table_name", name)
        joined = sliced_join(joined, end(prefix), [name], spread, counts).withColumn(
            "links", _known_links(F.col("links"), prefix + "columns", column)
        ).drop(prefix + "columns")
    return joined.select(
        "event_id", "event_time", "run_id", "in_pos", "out_pos", *EDGE_KEY, "from_name", "to_name",
        _column_pairs(F.col("links"), "from_", "to_").alias("column_pairs"),
    )


def column_set(column_pairs: Column) -> Column:
    """Column pairs as a sorted set."""
    return F.array_sort(F.array_distinct(column_pairs))


def column_rows(edges: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per column pair."""
    return edges.select(*keep, F.explode("column_pairs").alias("pair")).select(
        *keep,
        F.col("pair.fromColumns")[0].alias("from_column"),
        F.col("pair.toColumn").alias("to_column"),
    )


def upsert(edges: DataFrame) -> DataFrame:
    """The last arrival per pair of entities wins and replaces the details as a whole.

    Works on a batch, on a stored table, or on their union; repeating rows changes nothing.
    """
    order = [c for c in ARRIVAL]
    details = [c for c in edges.columns if c not in EDGE_KEY and c not in ARRIVAL]
    last = F.max_by(F.struct(*order, *details), F.struct(*order, *_ties(details, edges)))
    return edges.groupBy(*EDGE_KEY).agg(last.alias("last")).select(*EDGE_KEY, "last.*")


def _ties(details: Sequence[str], edges: DataFrame) -> list[str]:
    """Datasets may share a position in derived data; their names then settle the order."""
    return [c for c in ("from_name", "to_name") if c in details and c in edges.columns]
